"""Removal of long repeated byte strings with suffix arrays of shards (operator 10).

A byte goes when a string of ``least`` bytes that covers it also starts anywhere else, in the same document or another.

Shards.  Each string of ``least`` bytes (a window) has an anchor: of the 32-byte strings in it, that with the smallest
hash, the first at a tie.  Equal windows have equal anchors at equal places, so windows can be compared anchor by
anchor.  Consecutive windows with one anchor form a piece, a stretch of text of ``least`` bytes and some more.  Anchors
that stand alone in the corpus, most of them, need no more work; where all pieces of an anchor are equal, or one is
there twice, all its windows repeat.  The different pieces of an anchor, one of each, go to a shard together.

In a shard the pieces lie one after another, with a mark after each, and get a suffix array by induced sorting.  The
permuted common prefixes cut it into classes of suffixes that agree in ``least`` bytes; a class with two windows is a
repeat.  Each window begins in one piece only, so no text is compared with itself.

An anchor with more than ``crowd`` different pieces, a line that very many documents share, would make a shard too large
for a task.  Its pieces are cut again by anchors of another hash: windows that are equal still choose alike, and most
choose outside the shared line and stand alone.  So a few rounds leave next to nothing crowded.  What is then still
crowded is counted window by window by a digest, with a sum before the shuffle.  The result is the same.
"""

import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from deskflow.llm.common import AT_ONCE, small_batches
from deskflow.llm.suffix import permuted_common_prefixes, suffix_array
from deskflow.sources.stage import stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LEAST = 200
_GRAM = 32
_BUFFER = 1 << 17
_SHARD = 1 << 18
_CROWD = 2048
_ROUNDS = 4
# Bytes that UTF-8 never uses, one higher: the mark after a piece.
_MARK = 255

_PIECES = "array<struct<h:long,d:long,a:int,n:int>>"


def _pieces_in(b: np.ndarray, low: np.ndarray, high: np.ndarray, least: int, level: int = 0):
    """Pieces of the texts b[low:high]: text number, anchor hash, digest, first window, windows.

    Each ``level`` has a hash of its own.
    """
    n = len(b)
    words = np.ndarray((n - 7,), "<u8", b, strides=(1,))
    grams = n - _GRAM + 1
    h = np.zeros(grams, np.uint64)
    for k, odd in enumerate((0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)):
        h += words[8 * k:8 * k + grams] * np.uint64(odd)
    h += np.uint64(level * 0x9FB21C651E98DF25 & 0xFFFFFFFFFFFFFFFF)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(29)
    # Smallest hash, then first place, over the grams of each window.
    key = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(grams, dtype=np.uint64)
    over, width = 1, least - _GRAM + 1
    while over * 2 <= width:
        key = np.minimum(key[:-over], key[over:])
        over *= 2
    if over < width:
        key = np.minimum(key[:len(key) - (width - over)], key[width - over:])
    anchor = (key & np.uint64(0xFFFFFFFF)).astype(np.int64)
    valid = np.zeros(n + 1, np.int32)
    long = high - low >= least
    valid[low[long]] += 1
    valid[high[long] - least + 1] -= 1
    start = np.flatnonzero(np.cumsum(valid[:-1]))
    if not len(start):
        return [np.zeros(0, np.int64)] * 5
    at = anchor[start]
    first = np.r_[True, (np.diff(at) != 0) | (np.diff(start) != 1)]
    begin = start[first]
    size = np.diff(np.r_[np.flatnonzero(first), len(start)])
    view, digest = memoryview(b), xxhash.xxh3_64_intdigest
    d = np.fromiter((digest(view[x:x + m + least - 1]) for x, m in zip(begin.tolist(), size.tolist())), np.uint64, len(begin))
    return np.searchsorted(low, begin, "right") - 1, h[at[first]].view(np.int64), d.view(np.int64), begin, size


def _pieces(least: int):
    def of(texts: list[bytes]) -> pa.Array:
        rows: list[list[np.ndarray]] = []

        def add(number, data, low, high, shift):
            if len(data) < max(least, _GRAM):
                return
            who, h, d, a, n = _pieces_in(np.frombuffer(data, np.uint8), low, high, least)
            if len(who):
                rows.append([number[who], h, d, a - shift[who], n])

        waiting, size = [], 0

        def flush():
            nonlocal waiting, size
            if waiting:
                length = np.array([len(texts[i]) for i in waiting])
                low = np.cumsum(length) - length
                add(np.array(waiting), b"".join([texts[i] for i in waiting]), low, low + length, low)
            waiting, size = [], 0

        for i, t in enumerate(texts):
            if len(t) < least:
                continue
            if len(t) > 2 * _BUFFER:
                # A very long text goes by stretches of windows; where they meet, a piece is only cut in two.
                for s in range(0, len(t) - least + 1, _BUFFER):
                    part = t[s:s + _BUFFER + least - 1]
                    add(np.array([i]), part, np.zeros(1, np.int64), np.array([len(part)]), np.array([-s]))
                continue
            waiting.append(i)
            size += len(t)
            if size >= _BUFFER:
                flush()
        flush()
        cols = [np.concatenate(c) for c in zip(*rows)] if rows else [np.zeros(0, np.int64)] * 5
        order = np.argsort(cols[0], kind="stable")
        who, h, d, a, n = [c[order] for c in cols]
        offsets = np.searchsorted(who, np.arange(len(texts) + 1))
        parts = pa.StructArray.from_arrays(
            [pa.array(h), pa.array(d), pa.array(a.astype(np.int32)), pa.array(n.astype(np.int32))], ["h", "d", "a", "n"])
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), parts)

    return of


def pieces_of(data: Column, least: int) -> Column:
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        of = _pieces(least)
        for batch in batches:
            # A few texts at a time are held as Python objects.
            for k in range(0, len(batch), AT_ONCE):
                yield of([x or b"" for x in batch.slice(k, AT_ONCE).to_pylist()])
            pa.default_memory_pool().release_unused()

    return F.arrow_udf(run, _PIECES)(data)


def repeated_windows(pieces: list[bytes], windows: list[int], copies: list[int], least: int) -> list[tuple[int, int, int]]:
    """(piece, first window, windows) of the runs of windows that repeat, in the pieces that are there once."""
    mark = bytes([_MARK - 1])
    s = np.frombuffer(mark.join(pieces) + mark + b"\xff", np.uint8) + np.uint8(1)
    length = np.array([len(p) + 1 for p in pieces])
    low = np.cumsum(length) - length
    weight = np.zeros(len(s), np.int64)
    once = np.zeros(len(s) + 1, np.int64)
    for a, n, c in zip(low.tolist(), windows, copies):
        weight[a:a + n] = c
        if c == 1:
            once[a] += 1
            once[a + n] -= 1
    sa = suffix_array(s)
    common = permuted_common_prefixes(s, sa)
    kind = np.empty(len(s), np.int64)
    kind[sa] = np.cumsum(common[sa] < least)
    total = np.bincount(kind, weight)
    found = (total[kind] >= 2) & (np.cumsum(once[:-1]) > 0)
    edge = np.diff(np.r_[0, found.astype(np.int8), 0])
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    # Runs end with their piece: the mark after it is no window.
    who = np.searchsorted(low, begin, "right") - 1
    return list(zip(who.tolist(), (begin - low[who]).tolist(), (end - begin).tolist()))


def _sharded(least: int, target: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size, last = [], 0, None

        def shard():
            found = repeated_windows([r["piece"] for r in rows], [r["n"] for r in rows], [r["copies"] for r in rows], least)
            return pa.RecordBatch.from_arrays([
                pa.array([rows[k]["tid"] for k, _, _ in found], pa.binary()),
                pa.array([rows[k]["a"] + f for k, f, _ in found], pa.int32()),
                pa.array([n for _, _, n in found], pa.int32())], ["tid", "a", "n"])

        for batch in batches:
            for k in range(0, len(batch), 256):
                for r in batch.slice(k, 256).to_pylist():
                    if size >= target and r["h"] != last:
                        yield shard()
                        rows, size = [], 0
                    rows.append(r)
                    size += len(r["piece"])
                    last = r["h"]
        if rows:
            yield shard()

    return run


def _cut_again(least: int, level: int):
    """Pieces of the pieces of crowded anchors, by the anchors of another hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(0, len(whole), AT_ONCE):
                batch = whole.slice(k, AT_ONCE)
                pieces = batch.column("piece").to_pylist()
                length = np.array([len(p) for p in pieces])
                low = np.cumsum(length) - length
                data = b"".join(pieces)
                who, h, d, begin, size = _pieces_in(np.frombuffer(data, np.uint8), low, low + length, least, level)
                own = pa.array(who)
                mixed = (batch.column("h").to_numpy()[who] * np.int64(0x5851F42D4C957F2D)) ^ h
                first = batch.column("a").to_numpy()[who] + begin - low[who]
                yield pa.RecordBatch.from_arrays([
                    pa.array(mixed), pa.array(d), batch.column("tid").take(own), pa.array(first.astype(np.int32)),
                    pa.array(size.astype(np.int32)), batch.column("copies").take(own),
                    pa.array([data[b:b + n + least - 1] for b, n in zip(begin.tolist(), size.tolist())], pa.binary())],
                    ["h", "d", "tid", "a", "n", "copies", "piece"])

    return run


def _finer(crowded: DataFrame, least: int, level: int, crowd: int) -> tuple[DataFrame, DataFrame]:
    """Of pieces of crowded anchors: those that repeat whole (tid, a, n), and one of each of the others, with ``crowded``.

    A piece that is there more than once only weighs in with its copies, for its windows are known to repeat.
    """
    cut = stage(crowded.mapInArrow(_cut_again(least, level), "h long, d long, tid binary, a int, n int, copies long, piece binary"),
                "finer")
    kinds = cut.groupBy("h", "d").agg(F.sum("copies").alias("all"), F.min(F.struct("tid", "a")).alias("rep"))
    size = kinds.groupBy("h").agg(F.count("*").alias("kinds"))
    kinds = stage(kinds.join(size, "h").where("kinds > 1 OR all > 1"), "kinds")
    whole = cut.where("copies = 1").select("h", "d", "tid", "a", "n").join(kinds.where("all > 1").select("h", "d"), ["h", "d"])
    some = kinds.where("kinds > 1").select("h", "rep.tid", "rep.a", "all", (F.col("kinds") > crowd).alias("crowded"))
    rest = cut.drop("copies", "d").join(some, ["h", "tid", "a"]).withColumnRenamed("all", "copies")
    return whole.select("tid", "a", "n"), rest.select("h", "tid", "a", "n", "copies", "piece", "crowded")


def _windows(least: int):
    """One row per window of the pieces of a crowded anchor, with a digest of 128 bits."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                n = r["n"]
                yield pa.RecordBatch.from_arrays([
                    pa.array([hashlib.blake2b(r["piece"][k:k + least], digest_size=16).digest() for k in range(n)], pa.binary()),
                    pa.array([r["tid"]] * n, pa.binary()), pa.array(range(r["a"], r["a"] + n), pa.int32()),
                    pa.array([r["copies"]] * n, pa.int64())], ["w", "tid", "a", "copies"])

    return run


def _spans(marks: list[dict], least: int) -> list[tuple[int, int]]:
    """Runs of windows (a, n) as maximal runs (first, end) of the bytes they cover."""
    out: list[list[int]] = []
    for a, n in sorted((m["a"], m["n"]) for m in marks):
        end = a + n - 1 + least
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([a, end])
    return [(a, e) for a, e in out]


def _cutter(least: int):
    def run(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for data, marks in batches:
            spans, kept = [], []
            for i in range(len(data)):
                b = memoryview(data[i].as_buffer())
                runs, at, digest = _spans(marks[i].as_py(), least), 0, hashlib.sha256()
                for first, end in runs:
                    digest.update(b[at:first])
                    at = end
                digest.update(b[at:])
                spans.append([{"first": f, "bytes": e - f} for f, e in runs])
                kept.append(digest.hexdigest())
            fields = [pa.field("spans", pa.list_(pa.struct([("first", pa.int64()), ("bytes", pa.int64())]))),
                      pa.field("kept_sha256", pa.string())]
            yield pa.StructArray.from_arrays([pa.array(spans, fields[0].type), pa.array(kept)], fields=fields)

    return run


def _keyed(docs: DataFrame, text_col: str) -> tuple[Column, Column]:
    data = F.encode(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")), "UTF-8")
    return F.unhex(F.md5(data)), data


def spans_by_text(docs: DataFrame, text_col: str = "text", least: int = LEAST, crowd: int = _CROWD,
                  shard_bytes: int = _SHARD) -> DataFrame:
    """(tid, spans, kept_sha256) of every distinct text that loses bytes; ``tid`` is the MD5 of its UTF-8 bytes."""
    if least < _GRAM:
        raise ValueError(f"Repeats of fewer than {_GRAM} bytes have no anchor.")
    small_batches(docs.sparkSession)
    tid, data = _keyed(docs, text_col)
    texts = docs.select(tid.alias("tid"), data.alias("data")).where(F.octet_length("data") >= least)
    # Written, as it is read twice.  So is what it is joined with: then both sides come from plain shuffles, and the share of
    # an anchor that very many texts have can be split among tasks.
    flat = stage(texts.select("tid", pieces_of(F.col("data"), least).alias("p")).select("tid", F.inline("p")), "flat")
    several = stage(flat.groupBy("h").agg(F.count("*").alias("rows"), F.min("d").alias("d0"), F.max("d").alias("d1")).where(
        "rows > 1").select("h", F.expr("d0 = d1").alias("alike")), "anchors")
    joined = stage(flat.join(several, "h"), "pieces")

    # Different pieces of an anchor: how often each is there, and a text that has it.
    mixed = joined.where("NOT alike").groupBy("h", "d").agg(
        F.count("*").alias("copies"), F.min(F.struct("tid", "a", "n")).alias("rep"))
    size = mixed.groupBy("h").count().select("h", (F.col("count") > crowd).alias("crowded"))
    mixed = stage(mixed.join(size, "h"), "mixed")

    whole = joined.where("alike").select("tid", "a", "n").union(
        joined.where("NOT alike").join(mixed.where("copies > 1").select("h", "d"), ["h", "d"]).select("tid", "a", "n"))
    asked = mixed.select("rep.tid", "rep.a", "rep.n", "h", "copies", "crowded")
    nothing = [F.lit(None).cast(k).alias(c) for c, k in (("h", "long"), ("copies", "long"), ("crowded", "boolean"))]
    marks = whole.select("tid", "a", "n", *nothing).union(asked).groupBy("tid").agg(
        F.collect_set(F.struct("a", "n", "h", "copies", "crowded")).alias("marks"))
    # One row per distinct text, copies being united before the shuffle.
    found = stage(texts.groupBy("tid").agg(F.first("data").alias("data")).join(marks, "tid"), "texts")

    asked = found.select("tid", "data", F.explode(F.filter("marks", lambda m: m["h"].isNotNull())).alias("m"))
    pieces = asked.select("m.h", "tid", "m.a", "m.n", "m.copies", "m.crowded", F.expr(
        f"substring(data, m.a + 1, m.n + {least - 1})").alias("piece"))
    plain, left, known = pieces.where("NOT crowded").drop("crowded"), pieces.where("crowded").drop("crowded"), []
    for level in range(1, _ROUNDS + 1):
        if (mixed if level == 1 else rest).where("crowded").isEmpty():
            break
        whole, rest = _finer(left, least, level, crowd)
        rest = stage(rest, "rest")
        known.append(whole)
        plain = plain.unionByName(rest.where("NOT crowded").drop("crowded"))
        left = rest.where("crowded").drop("crowded")
    ranges = plain.repartition("h").sortWithinPartitions("h").mapInArrow(
        _sharded(least, shard_bytes), "tid binary, a int, n int")
    for whole in known:
        ranges = ranges.union(whole)
    windows = left.mapInArrow(_windows(least), "w binary, tid binary, a int, copies long")
    again = windows.groupBy("w").agg(F.sum("copies").alias("all")).where("all > 1").select("w")
    ranges = ranges.union(windows.where("copies = 1").join(again, "w").select("tid", "a", F.lit(1).alias("n")))
    more = stage(ranges.groupBy("tid").agg(F.collect_list(F.struct("a", "n")).alias("more")), "ranges")

    own = F.transform(F.filter("marks", lambda m: m["h"].isNull()),
                      lambda m: F.struct(m["a"].alias("a"), m["n"].alias("n")))
    both = found.join(more, "tid", "left").select(
        "tid", "data", F.concat(own, F.coalesce("more", F.array().cast("array<struct<a:int,n:int>>"))).alias("all"))
    kind = "spans array<struct<first:long,bytes:long>>, kept_sha256 string"
    cut = _cutter(least)

    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        return cut(batches)

    result = both.where(F.size("all") > 0).select("tid", F.arrow_udf(run, kind)("data", "all").alias("r"))
    return result.select("tid", "r.spans", "r.kept_sha256")


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST,
            crowd: int = _CROWD) -> DataFrame:
    """(id, n_bytes, n_removed, spans, kept_sha256) of every row; spans are maximal runs of removed bytes.

    Null text: no bytes.  Of repeated rows all lose what they share, each being elsewhere for the others.  Null ids
    and an empty table need nothing special: texts are known by their digest.
    """
    found = stage(spans_by_text(docs, text_col, least, crowd), "spans")
    tid, data = _keyed(docs, text_col)
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), tid.alias("tid"),
                       F.octet_length(data).cast("long").alias("n_bytes"), F.sha2(data, 256).alias("own"))
    spans = F.coalesce("spans", F.array().cast("array<struct<first:long,bytes:long>>"))
    return rows.join(found, "tid", "left").select(
        "id", "n_bytes", F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["bytes"]).alias("n_removed"),
        spans.alias("spans"), F.coalesce("kept_sha256", "own").alias("kept_sha256"))


def _kept_text(data: bytes, spans: list[dict]) -> str:
    """What is left of a text; a character goes when all its bytes do."""
    b = np.frombuffer(data, np.uint8)
    keep = np.ones(len(b), bool)
    for s in spans:
        keep[s["first"]:s["first"] + s["bytes"]] = False
    head = np.flatnonzero((b & 0xC0) != 0x80)
    stays = np.logical_or.reduceat(keep, head)
    return b[np.repeat(stays, np.diff(np.r_[head, len(b)]))].tobytes().decode()


def without_repeats(docs: DataFrame, text_col: str = "text", length_col: str = "n_chars", least: int = LEAST,
                    crowd: int = _CROWD) -> DataFrame:
    """All rows and columns of ``docs``, with the text left after the cut, and its length where there is such a column.

    Only whole characters go: of one that is partly covered nothing is removed.
    """
    found = stage(spans_by_text(docs, text_col, least, crowd), "spans")
    tid, data = _keyed(docs, text_col)

    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, spans in batches:
            for k in range(0, len(texts), AT_ONCE):
                pairs = zip(texts.slice(k, AT_ONCE).to_pylist(), spans.slice(k, AT_ONCE).to_pylist())
                yield pa.array([t if not s else _kept_text(t.encode(), s) for t, s in pairs], pa.string())
            pa.default_memory_pool().release_unused()

    # The columns travel as one, so that none can clash with those of the spans.
    rows = docs.select(F.struct("*").alias("_row"), tid.alias("_tid"))
    cut = rows.join(found.select(F.col("tid").alias("_tid"), F.col("spans").alias("_spans")), "_tid", "left")
    cut = cut.select("_row", F.arrow_udf(run, "string")(F.col(f"_row.`{text_col}`"), "_spans").alias("_text"),
                     F.col("_spans").isNotNull().alias("_less"))
    columns = []
    for c in docs.columns:
        own = F.col(f"_row.`{c}`")
        if c == text_col:
            own = F.col("_text")
        elif c == length_col:
            own = F.when(F.col("_less"), F.length("_text").cast(docs.schema[c].dataType)).otherwise(own)
        columns.append(own.alias(c))
    return cut.select(*columns)
