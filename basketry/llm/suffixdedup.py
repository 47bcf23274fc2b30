"""Removal of long repeated passages with run-length indexes.

A byte goes when a ``window``-byte string that covers it also starts in a document with a smaller
id.  No task sees the whole corpus, so equal windows are first brought together: the anchor of a
window is the place in it whose 24-byte string hashes lowest.  Equal windows have equal anchors,
and neighbouring windows mostly share theirs, so a document falls into segments, runs of windows
with one anchor, of some 63 bytes each.

1. Anchor hashes are counted over all documents.  Only those found in two or more can belong to
   a repeated window; they set their bits in a filter of fixed size (2 ** ``filter_bits``), the
   one thing that is broadcast.  A wrong hit costs work and changes nothing.
2. Segments that pass are dealt by anchor hash, equal ones of a batch once.  An anchor that more
   than ``hot_documents`` documents hold would deal a hot shard; its segments are cut into single
   windows and dealt by the window, and inside a batch equal windows are one.
3. A segment whose anchor no different segment has can only repeat as a whole, and its documents
   are known.  Of the others each shard builds the run-compressed transform with sampled run ends,
   streams their matching statistics through it, and marks every window-long match whose class
   (the rows that share it) has a smaller document.
4. Documents meet their marked spans, by id and text digest, and lose those bytes.

Defined results: null counts as empty; a null id counts as the smallest bigint; rows with the
same id never remove from each other; texts shorter than the window stay whole; an empty table
gives an empty result; columns other than the id and the text are ignored.
"""

from __future__ import annotations

import hashlib
from array import array

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from basketry.llm.common import bodies, python_rows, restored, shuffle_width
from basketry.llm.runindex import RunIndex

WINDOW = 50
GRAM = 24
FILTER_BITS = 27
HOT_BITS = 22
HOT_DOCUMENTS = 1 << 14
CHUNK_BYTES = 1 << 19
NULL_ID = -(1 << 63)
_LOW = np.uint64(0xFFFFFFFF)
_SHIFT = np.uint64(32)

KEY_SCHEMA = ("shard int, base bigint, keys binary, docs binary, more_keys binary, "
              "more_docs binary, more_n binary")
FILTER_SCHEMA = "shard int, bits binary, hot binary"
SEGMENT_SCHEMA = ("shard int, base bigint, texts binary, sizes binary, anchors binary, "
                  "segment binary, doc binary, digest binary, start binary")
SPAN_SCHEMA = "doc_id bigint, digest bigint, span bigint"


def text_digest(body: bytes) -> int:
    """32 bits that tell rows with the same id apart."""
    return xxhash.xxh3_64_intdigest(body) & 0xFFFFFFFF


def windowed_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` values in a row, by doubling."""
    span, out = 1, values
    while 2 * span <= width:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    return out if span == width else np.minimum(out[:span - width], out[width - span:])


def segments(buffer: bytes, starts: np.ndarray, window: int = WINDOW):
    """Segments of texts laid end to end: ``(text, first window, windows, anchor hash)``.

    First windows count from the start of the text.  Of equal hashes the rightmost place wins,
    which depends on the window alone.
    """
    n = len(buffer)
    if n < window:
        return tuple(np.empty(0, dtype=t) for t in (np.int64, np.int64, np.int64, np.uint64))
    padded = buffer + bytes(GRAM)
    words = np.ndarray((n + GRAM - 7,), dtype="<u8", buffer=padded, strides=(1,))
    h = words[:n] * np.uint64(0x9E3779B97F4A7C15)
    for at in range(8, GRAM, 8):
        h ^= h >> np.uint64(31)
        h += words[at:n + at] * np.uint64(0xC2B2AE3D27D4EB4F)
        h *= np.uint64(0x165667B19E3779F9)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> _SHIFT
    places = np.arange(n, dtype=np.uint64)
    ranked = (h & ~_LOW) | (_LOW - places)  # high half of the hash, then the rightmost place
    anchor = _LOW - (windowed_min(ranked, window - GRAM + 1)[:n - window + 1] & _LOW)
    ends = np.append(starts[1:], n)
    text = np.repeat(np.arange(len(starts)), ends - starts)[:n - window + 1]
    first = np.flatnonzero(np.arange(n - window + 1) <= ends[text] - window)
    if not len(first):
        return segments(b"", starts, window)
    a = anchor[first]
    new = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))
    count = np.diff(np.append(new, len(first)))
    at = first[new]
    owner = text[at]
    # Anchors have low hashes; mixed again, their keys fill all 64 bits evenly.
    keys = h[a[new].astype(np.int64)] * np.uint64(0x9FB21C651E98DF25)
    keys ^= keys >> np.uint64(28)
    return owner, at - starts[owner], count, keys * np.uint64(0xD6E8FEB86659FD93)


def _texts(batches, chunk: int = CHUNK_BYTES):
    """Ids, bodies, and the bodies end to end with their starts, some text at a time."""
    for batch in batches:
        ids = [NULL_ID if i is None else i for i in batch.column("doc_id").to_pylist()]
        texts = batch.column("body").to_pylist()
        start, held = 0, 0
        for i, body in enumerate(texts):
            held += len(body)
            if held >= chunk or i + 1 == len(texts):
                part = texts[start:i + 1]
                sizes = np.array([len(b) for b in part], dtype=np.int64)
                yield ids[start:i + 1], part, b"".join(part), np.cumsum(sizes) - sizes
                start, held = i + 1, 0


def _narrow(values: np.ndarray) -> bytes:
    """Non-negative numbers in as few bytes each as the largest needs."""
    top = int(values.max(initial=0))
    kind = np.uint16 if top < 1 << 16 else np.uint32 if top < 1 << 32 else np.uint64
    return values.astype(kind).tobytes()


def _wide(data: bytes, count: int) -> np.ndarray:
    if not count:
        return np.empty(0, dtype=np.uint64)
    return np.frombuffer(data, dtype=f"<u{len(data) // count}").astype(np.uint64)


def _from_base(ids: np.ndarray, base: int) -> np.ndarray:
    """Distance of ids from the least one; wraps around where ids span all 64 bits."""
    return ids.astype(np.uint64) - np.array(base).astype(np.uint64)


def _to_ids(distance: np.ndarray, base: int) -> np.ndarray:
    return (distance + np.array(base).astype(np.uint64)).astype(np.int64)


def _key_rows(keys: np.ndarray, ids: np.ndarray, shard_bits: int):
    """One record per shard: each key with its least document, repeated keys with the greatest
    document and the number of documents too."""
    order = np.lexsort((ids, keys))
    keys, ids = keys[order], ids[order]
    new = np.concatenate([[True], keys[1:] != keys[:-1]])
    at = np.flatnonzero(new)
    other = new | np.concatenate([[True], ids[1:] != ids[:-1]])
    n = np.add.reduceat(other.astype(np.int64), at)
    last = np.append(at[1:], len(keys)) - 1
    keys, least, most = keys[at], ids[at], ids[last]
    shards = (keys >> np.uint64(64 - shard_bits)).astype(np.int64)
    borders = np.append(np.flatnonzero(np.concatenate([[True], shards[1:] != shards[:-1]])),
                        len(shards))
    low = (keys & _LOW).astype(np.uint32)
    out = []
    for a, b in zip(borders[:-1], borders[1:], strict=True):
        base = int(least[a:b].min())
        more = a + np.flatnonzero(n[a:b] > 1)
        out.append((int(shards[a]), base, low[a:b].tobytes(), _narrow(_from_base(least[a:b], base)),
                    low[more].tobytes(), _narrow(_from_base(most[more], base)),
                    _narrow(n[more])))
    return out


def _records(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _arrow(schema: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}
    return pa.schema([(n, kinds[t]) for n, t in (f.split() for f in schema.split(", "))])


def _key_step(window: int, shard_bits: int, held_keys: int = 1 << 20):
    def step(batches):
        schema, held, size = _arrow(KEY_SCHEMA), [], 0
        for ids, _, buffer, starts in _texts(batches):
            owner, _, _, keys = segments(buffer, starts, window)
            held.append((keys, np.array(ids, dtype=np.int64)[owner]))
            size += len(keys)
            if size >= held_keys:
                yield _records(_key_rows(*map(np.concatenate, zip(*held, strict=True)),
                                         shard_bits), schema)
                held, size = [], 0
        if size:
            yield _records(_key_rows(*map(np.concatenate, zip(*held, strict=True)), shard_bits),
                           schema)
    return step


def _by_shard(batches):
    """Rows of one shard at a time; rows come ordered by shard."""
    at, held = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if row["shard"] != at:
                if held:
                    yield at, held
                at, held = row["shard"], []
            held.append(row)
    if held:
        yield at, held


def _filter_step(bits: int, hot_documents: int):
    """Per shard: the bits of keys that two documents hold, and hot keys."""
    def step(batches):
        schema = _arrow(FILTER_SCHEMA)
        for shard, rows in _by_shard(batches):
            keys, least, most, n = [], [], [], []
            for r in rows:
                k = np.frombuffer(r["keys"], dtype=np.uint32)
                more = np.frombuffer(r["more_keys"], dtype=np.uint32)
                d = _to_ids(_wide(r["docs"], len(k)), r["base"])
                keys += [k, more]
                least += [d, _to_ids(_wide(r["more_docs"], len(more)), r["base"])]
                n += [np.ones(len(k), np.int64),
                      _wide(r["more_n"], len(more)).astype(np.int64) - 1]
            keys, least, n = map(np.concatenate, (keys, least, n))
            order = np.argsort(keys, kind="stable")
            keys, least, n = keys[order], least[order], n[order]
            at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            shared = np.minimum.reduceat(least, at) < np.maximum.reduceat(least, at)
            flags = np.zeros(1 << bits, dtype=bool)
            flags[keys[at][shared] & np.uint32((1 << bits) - 1)] = True
            hot = keys[at][np.add.reduceat(n, at) > hot_documents] & np.uint32((1 << HOT_BITS) - 1)
            yield _records([(shard, np.packbits(flags, bitorder="little").tobytes(),
                             np.unique(hot).tobytes())], schema)
    return step


def _bit(bits: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0


def _segment_step(window: int, shard_bits: int, bits: int, shared):
    """Segments that may repeat, one record per shard and batch."""
    def step(batches):
        passing, hot_bits = shared.value
        schema = _arrow(SEGMENT_SCHEMA)
        held: dict[int, tuple[dict, array, array]] = {}
        size = 0

        def put(shard, text, anchor, *place):
            nonlocal size
            texts, anchors, places = (held.get(shard)
                                      or held.setdefault(shard, ({}, array("I"), array("q"))))
            known = len(texts)
            places.extend((texts.setdefault(text, known), *place))
            if len(texts) > known:
                anchors.append(anchor)
                size += 250 + len(text)
            size += 32

        def rows():
            out = []
            for shard, (texts, anchors, places) in held.items():
                segment, doc, digest, start = np.array(places).reshape(-1, 4).T
                base = int(doc.min())
                sizes = np.array([len(t) for t in texts])
                out.append((shard, base, pa.compress(b"".join(texts), "zstd", asbytes=True),
                            _narrow(sizes), anchors.tobytes(), _narrow(segment),
                            _narrow(_from_base(doc, base)), digest.astype(np.uint32).tobytes(),
                            _narrow(start)))
            return _records(out, schema)

        for ids, texts, buffer, starts in _texts(batches):
            owner, first, count, keys = segments(buffer, starts, window)
            shard = (keys >> np.uint64(64 - shard_bits)).astype(np.int64)
            low = (keys & _LOW).astype(np.int64)
            found = np.flatnonzero(_bit(passing, (shard << bits) | (low & ((1 << bits) - 1))))
            hot = _bit(hot_bits, low[found] & ((1 << HOT_BITS) - 1))
            digests: dict[int, int] = {}
            for o, s, c, k, a, h in zip(
                    owner[found].tolist(), first[found].tolist(), count[found].tolist(),
                    shard[found].tolist(), low[found].tolist(), hot.tolist(), strict=True):
                if (digest := digests.get(o)) is None:
                    digest = digests[o] = text_digest(texts[o])
                text = texts[o]
                if not h:
                    put(k, text[s:s + c + window - 1], a, ids[o], digest, s)
                else:
                    for w in range(s, s + c):
                        one = text[w:w + window]
                        key = xxhash.xxh3_64_intdigest(one)
                        put(key >> (64 - shard_bits), one, key & 0xFFFFFFFF, ids[o], digest, w)
            if size > 64 << 20:
                yield rows()
                held.clear()
                size = 0
        if held:
            yield rows()
    return step


def repeated_windows(texts: list[bytes], docs: np.ndarray, window: int) -> list[np.ndarray]:
    """Per text, the least document in which the window at each place occurs.

    ``docs``: the least document of each (distinct) text.
    """
    index = RunIndex(texts, window)
    least = index.least(docs)
    sizes = np.array([len(t) for t in texts])
    out: list[np.ndarray] = [np.empty(0)] * len(texts)
    order = np.argsort(sizes, kind="stable")
    step = 1 << 14
    for at in range(0, len(texts), step):  # texts of like size stream together
        part = order[at:at + step]
        lengths, rows = index.matching_statistics([texts[i] for i in part])
        found = np.where(lengths >= window, least[index.class_of_row[rows]],
                         np.iinfo(np.int64).max)
        for i, row in zip(part.tolist(), found, strict=True):
            out[i] = row[:sizes[i] - window + 1]
    return out


def _span_step(window: int):
    """Build the index of a shard, stream its segments, and give the spans that go."""
    def step(batches):
        for _, rows in _by_shard(batches):
            texts: dict[bytes, int] = {}
            anchors = array("I")
            segment, doc, digest, start = [], [], [], []
            for r in rows:
                n = len(r["digest"]) // 4
                places = _wide(r["segment"], n).astype(np.int64)
                anchor = np.frombuffer(r["anchors"], dtype=np.uint32)
                sizes = _wide(r["sizes"], len(anchor)).astype(np.int64)
                ends = np.cumsum(sizes)
                data = pa.decompress(r["texts"], int(ends[-1]), "zstd", asbytes=True)
                number = np.empty(len(sizes), dtype=np.int64)
                for i, (a, b) in enumerate(zip((ends - sizes).tolist(), ends.tolist(),
                                               strict=True)):
                    known = len(texts)
                    number[i] = texts.setdefault(data[a:b], known)
                    if len(texts) > known:
                        anchors.append(int(anchor[i]))
                segment.append(number[places])
                doc.append(_to_ids(_wide(r["doc"], n), r["base"]))
                digest.append(np.frombuffer(r["digest"], dtype=np.uint32).astype(np.int64))
                start.append(_wide(r["start"], n).astype(np.int64))
            segment, doc, digest, start = map(np.concatenate, (segment, doc, digest, start))
            first = np.full(len(texts), np.iinfo(np.int64).max)
            np.minimum.at(first, segment, doc)
            least, offsets = _least_documents(list(texts), np.array(anchors), first, window)
            spans = _spans(segment, doc, digest, start, least, offsets, window)
            if len(spans[0]):
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in spans],
                                                 names=["doc_id", "digest", "span"])
    return step


def _least_documents(texts: list[bytes], anchors: np.ndarray, first: np.ndarray, window: int):
    """The least document of every window of all texts in a row, and where each text starts.

    The windows of a text whose anchor no other text has are found nowhere else; the others
    are looked up in the index of their texts.
    """
    counts = np.array([len(t) for t in texts]) - window + 1
    offsets = np.concatenate([[0], np.cumsum(counts)])
    least = np.repeat(first, counts)
    _, group, size = np.unique(anchors, return_inverse=True, return_counts=True)
    shared = np.flatnonzero(size[group] > 1)
    if len(shared):
        found = repeated_windows([texts[i] for i in shared.tolist()], first[shared], window)
        for i, row in zip(shared.tolist(), found, strict=True):
            least[offsets[i]:offsets[i + 1]] = row
    return least, offsets


def _spans(segment, doc, digest, start, least, offsets, window):
    """Maximal runs of windows that a smaller document holds, as byte spans per place."""
    counts = np.diff(offsets)[segment]
    place = np.repeat(np.arange(len(segment)), counts)
    within = np.arange(len(place)) - np.repeat(np.cumsum(counts) - counts, counts)
    gone = least[offsets[segment][place] + within] < doc[place]
    begins = gone.copy()
    begins[1:] &= ~gone[:-1] | (place[1:] != place[:-1])
    stops = gone.copy()
    stops[:-1] &= ~gone[1:] | (place[1:] != place[:-1])
    a, b = np.flatnonzero(begins), np.flatnonzero(stops)
    at = place[a]
    first = start[at] + within[a]
    return doc[at], digest[at], first << 32 | (first + within[b] - within[a] + window)


def _dealt(rows: DataFrame, width: int) -> DataFrame:
    return rows.repartitionById(width, F.col("shard")).sortWithinPartitions("shard")


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
                   window: int = WINDOW, filter_bits: int = FILTER_BITS,
                   hot_documents: int = HOT_DOCUMENTS, shards: int | None = None) -> DataFrame:
    """``(doc_id, digest, span)``: bytes to remove, start * 2 ** 32 + stop; spans may overlap.

    ``shards`` (default 16 for each shuffle partition) should leave a shard about a megabyte of
    segments; its index takes some 250 bytes of memory for each of them.
    """
    spark = docs.sparkSession
    context, width = spark.sparkContext, shuffle_width(spark)
    texts = bodies(docs, id_col, text_col)
    shard_bits = (shards or 16 * width - 1).bit_length()
    bits = max(3, filter_bits - shard_bits)  # of the filter, per shard
    keys = python_rows(texts, _key_step(window, shard_bits), KEY_SCHEMA)
    passing = np.zeros(1 << (shard_bits + bits - 3), dtype=np.uint8)
    hot = np.zeros(1 << HOT_BITS, dtype=bool)
    # The filter leaves the executors shard by shard, 2 ** filter_bits bits in all.
    for r in python_rows(_dealt(keys, width), _filter_step(bits, hot_documents),
                         FILTER_SCHEMA).collect():
        part = np.frombuffer(r["bits"], dtype=np.uint8)
        passing[r["shard"] * len(part):(r["shard"] + 1) * len(part)] = part
        hot[np.frombuffer(r["hot"], dtype=np.uint32)] = True
    shared = context.broadcast((passing, np.packbits(hot, bitorder="little")))
    found = python_rows(texts, _segment_step(window, shard_bits, bits, shared), SEGMENT_SCHEMA)
    return python_rows(_dealt(found, width), _span_step(window), SPAN_SCHEMA)


def _digest_step(batches):
    for batch in batches:
        ids = pa.array([NULL_ID if i is None else i for i in batch.column("doc_id").to_pylist()],
                       pa.int64())
        digests = pa.array([text_digest(b) for b in batch.column("body").to_pylist()], pa.int64())
        yield pa.RecordBatch.from_arrays([*batch.columns, ids, digests],
                                         names=[*batch.schema.names, "at_id", "at_digest"])


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching spans as one, in order."""
    out: list[tuple[int, int]] = []
    for start, stop in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], stop))
        else:
            out.append((start, stop))
    return out


def without(body: bytes, spans: list[tuple[int, int]]) -> bytes:
    kept, at = [], 0
    for start, stop in spans:
        kept.append(body[at:start])
        at = stop
    return b"".join([*kept, body[at:]])


def _cut_step(report: bool):
    def step(batches):
        for batch in batches:
            rows = []
            for body, found in zip(batch.column("body").to_pylist(),
                                   batch.column("spans").to_pylist(), strict=True):
                spans = merged([(s >> 32, s & 0xFFFFFFFF) for s in found or ()])
                kept = without(body, spans)
                rows.append((len(body), len(body) - len(kept), len(spans),
                             hashlib.sha256(kept).hexdigest() if report
                             else kept.decode("utf-8", "ignore") if spans
                             else body.decode("utf-8", "replace")))
            columns = list(zip(*rows, strict=True)) if rows else [()] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in columns[:3]),
                 pa.array(columns[3], pa.string())],
                names=[batch.schema.names[0], "n_bytes", "n_removed", "n_spans", "kept"])
    return step


def _cut(docs: DataFrame, id_col: str, text_col: str, report: bool, carried: bool, **options):
    # Dealt before they are gathered: spans of a document rarely meet inside a shard, and rows
    # travel lighter than partial lists.
    spans = (repeated_spans(docs, id_col, text_col, **options)
             .select(F.col("doc_id").alias("at_id"), F.col("digest").alias("at_digest"), "span")
             .repartition(shuffle_width(docs.sparkSession), "at_id", "at_digest")
             .groupBy("at_id", "at_digest").agg(F.collect_set("span").alias("spans")))
    whole = bodies(docs, id_col, text_col, carried)
    marked = python_rows(whole, _digest_step, T.StructType(
        [*whole.schema.fields, *(T.StructField(n, T.LongType()) for n in ("at_id", "at_digest"))]))
    joined = marked.join(spans, ["at_id", "at_digest"], "left")
    first = "_row" if carried else "doc_id"
    schema = T.StructType([whole.schema[first],
                           *(T.StructField(n, T.LongType())
                             for n in ("n_bytes", "n_removed", "n_spans")),
                           T.StructField("kept", T.StringType())])
    return python_rows(joined.select(first, "body", "spans"), _cut_step(report), schema)


def passage_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   **options) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` per row."""
    return _cut(docs, id_col, text_col, True, False, **options).withColumnRenamed(
        "kept", "kept_sha256")


def drop_repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                           **options) -> DataFrame:
    """``docs`` without the repeated passages; all columns and rows stay.

    Spans are bytes and may cut a character; the broken ends of such a character go too.
    """
    cut = _cut(docs, id_col, text_col, False, True, **options)
    return restored(cut, docs, text_col, F.col("kept"))
