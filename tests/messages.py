"""Hand-made messages, and the log's rules as a plain sequential program."""

from __future__ import annotations

import random
from decimal import Decimal

from pyspark.sql.types import Row

from tracelake.model import ALL_KINDS, LOG_DDL, TYPE_BY_NAME

SEG_A = "00000000-0000-7000-8000-00000000000a"
SEG_B = "00000000-0000-7000-8000-00000000000b"
SEG_C = "00000000-0000-7000-8000-00000000000c"
SLOTS = ("tag", "i", "u", "f", "ts", "bin", "s", "b")


def value(tag, content):
    row = dict.fromkeys(SLOTS)
    row["tag"] = tag
    slot = TYPE_BY_NAME[tag].slot
    row[slot] = Decimal(content) if slot == "u" else content
    return tuple(row[s] for s in SLOTS)


def message(seq, segment, source, kind, body):
    return (seq, segment, source, kind, *[body if k == kind else None for k in ALL_KINDS])


def start(seq, segment, time_ns, source, envelope=None):
    return message(seq, segment, envelope or source, "segment_start", (time_ns, source))


def end(seq, segment, time_ns, source="src"):
    return message(seq, segment, source, "segment_end", (time_ns,))


def schema(seq, segment, name, fields, source="src"):
    full = [(f + (None,))[:3] for f in fields]
    return message(seq, segment, source, "event_schema", (name, full))


def named(seq, segment, event, field, entries, source="src"):
    body = (event, field, [(value(tag, key), label) for tag, key, label in entries])
    return message(seq, segment, source, "named_values", body)


def event(seq, segment, time_ns, name, fields, source="src"):
    body = (time_ns, name, [(f, value(tag, content)) for f, tag, content in fields])
    return message(seq, segment, source, "event", body)


def log_of(spark, messages):
    return spark.createDataFrame(list(messages), LOG_DDL)


def key_of(v):
    """Hashable identity of a value tuple, type-strict and with signed zeros."""
    tag, *slots = v
    return (tag, *[repr(x) for x in slots])


def sequential_fold(messages, mode="update", tombstones=()):
    """One message at a time, in arrival order."""
    todo = [(m[0], m) for m in messages] + [(t[1], t) for t in tombstones]
    segments = {}
    for _, m in sorted(todo, key=lambda x: x[0]):
        if len(m) == 2:
            segments.pop(m[0], None)
            continue
        _, seg_id, envelope, kind, s_start, s_end, s_schema, s_named, _ = m
        if kind == "event" and mode == "update":
            continue
        seg = segments.setdefault(
            seg_id, {"source": envelope, "start": None, "end": None, "schemas": {}}
        )
        if kind == "segment_start":
            time_ns, seg["source"] = s_start
            seg["start"] = time_ns if seg["start"] is None else min(seg["start"], time_ns)
        elif kind == "segment_end":
            seg["end"] = s_end[0]
        elif kind == "event_schema":
            name, fields = s_schema
            seg["schemas"].setdefault(name, [(f, {}) for f in fields])
        elif kind == "named_values":
            name, field, entries = s_named
            for definition, values in seg["schemas"].get(name, ()):
                if definition[0] == field:
                    values.update({key_of(v): label for v, label in entries})
                    break
    return segments


def catalog_as_dicts(catalog):
    """A folded catalog in the shape of :func:`sequential_fold`."""
    out = {}
    for r in catalog.segments.collect():
        assert r.segment_id not in out
        out[r.segment_id] = {
            "source": r.source, "start": r.start_time_ns, "end": r.end_time_ns, "schemas": {},
        }
    for r in catalog.event_schemas.collect():
        fields = [((f.name, f.data_type, f.unit), {}) for f in r.fields]
        assert r.event_name not in out[r.segment_id]["schemas"]
        out[r.segment_id]["schemas"][r.event_name] = fields
    for r in catalog.value_tables.collect():
        definition, values = out[r.segment_id]["schemas"][r.event_name][r.field_pos]
        assert definition[0] == r.field_name
        values[key_of(plain(r.value))] = r.label
    return out


def plain(row):
    """Nested Rows as tuples and lists."""
    if isinstance(row, Row):
        return tuple(plain(x) for x in row)
    if isinstance(row, list):
        return [plain(x) for x in row]
    return bytes(row) if isinstance(row, bytearray) else row


def random_log(seed, size=150):
    """Messages in random order of kinds over few names, so rules collide."""
    rnd = random.Random(seed)
    segments, names, fields = (SEG_A, SEG_B, SEG_C), ("e", "f"), ("x", "y", "z")
    tags = (("int8", 1), ("uint8", 1), ("string", "1"), ("float64", 0.0), ("float64", -0.0),
            ("bool", True), ("uint64", 2**64 - 1), ("binary", b"\x01"))
    out = []
    for seq in rnd.sample(range(size * 3), size):
        seg, source = rnd.choice(segments), rnd.choice(("s1", "s2"))
        kind = rnd.random()
        if kind < 0.12:
            out.append(start(seq, seg, rnd.randrange(100), rnd.choice(("s1", "s2", "s3")), source))
        elif kind < 0.22:
            out.append(end(seq, seg, rnd.randrange(100), source))
        elif kind < 0.4:
            defined = [
                (rnd.choice(fields), rnd.choice(("int8", "float64")), rnd.choice((None, "V")))
                for _ in range(rnd.randrange(4))
            ]
            out.append(schema(seq, seg, rnd.choice(names), defined, source))
        elif kind < 0.75:
            entries = [(*rnd.choice(tags), f"l{rnd.randrange(50)}") for _ in range(rnd.randrange(4))]
            out.append(named(seq, seg, rnd.choice(names), rnd.choice(fields), entries, source))
        else:
            out.append(event(seq, seg, rnd.randrange(100), rnd.choice(names),
                             [("x", "int8", 1)], source))
    return out
