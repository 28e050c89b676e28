"""Language identification by rank-order profiles of n-grams (operator 7).

A text's n-grams are runs of one to three characters of its lower-cased letters, with one sign for all that stands
between words.  The profile of a language is its ``size`` most frequent n-grams over all training texts, most frequent
first.  A document is compared by out-of-place distance: each of its own most frequent n-grams counts the difference of
the two ranks, or ``size`` when the profile lacks it; the language of least distance wins, the first by name at a tie.
"""

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window, functions as F

from deskflow.llm.common import AT_ONCE, per_text, small_batches, texts_of, worker_memory

cloudpickle.register_pickle_by_value(sys.modules[__name__])

UNKNOWN = "und"
_BASE = 0x110000
_CHUNK = 1 << 20
_KEPT = 1 << 20


def _letters() -> np.ndarray:
    """True at the code points of letters."""
    memory = worker_memory("letters")
    if not memory:
        memory["is"] = np.fromiter((chr(c).isalpha() for c in range(_BASE)), bool, _BASE)
    return memory["is"]


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if len(parts) == 1:
        return parts[0]
    grams, back = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
    return grams, np.bincount(back, np.concatenate([c for _, c in parts])).astype(np.int64)


def grams_of(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of a text as numbers in rising order, and their counts."""
    parts = []
    for start in range(0, len(text), _CHUNK):
        # Chunks overlap by the two characters that an n-gram may need before it.
        low = (" " if start == 0 else text[start - 2:start]) + text[start:start + _CHUNK]
        # The last chunk ends its last word.
        codes = np.frombuffer((low + " " * (start + _CHUNK >= len(text))).lower().encode("utf-32-le"), np.uint32)
        a = np.where(_letters()[codes], codes, 0).astype(np.int64)
        skip = 0 if start == 0 else 2
        one = a[skip:]
        two = a[:-1] * _BASE + a[1:]
        three = two[:-1] * _BASE + a[2:]
        found = [one[one > 0]]
        found.append(two[max(skip - 1, 0):][((a[:-1] > 0) | (a[1:] > 0))[max(skip - 1, 0):]] + _BASE ** 3)
        found.append(three[(a[1:-1] > 0)] + 2 * _BASE ** 3)
        parts.append(np.unique(np.concatenate(found), return_counts=True))
    return _merged(parts) if parts else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, gram, n) of a task's texts; flushed when it knows very many n-grams."""
    waiting: dict[str, list] = {}

    def flush():
        for lang, parts in waiting.items():
            grams, n = _merged(parts)
            for k in range(0, len(grams), 10_000):
                g = grams[k:k + 10_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(g), pa.string()), pa.array(g), pa.array(n[k:k + 10_000])],
                    ["lang", "gram", "n"])
        waiting.clear()

    for batch in batches:
        for k in range(0, len(batch), AT_ONCE):
            part = batch.slice(k, AT_ONCE)
            for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                parts = waiting.setdefault(lang, [])
                parts.append(grams_of(text))
                if len(parts) >= 256:
                    waiting[lang] = [_merged(parts)]
        for lang, parts in waiting.items():
            waiting[lang] = [_merged(parts)]
        if sum(len(p[0][0]) for p in waiting.values()) > _KEPT:
            yield from flush()
    yield from flush()


def profiles(labelled: DataFrame, lang_col: str = "lang", text_col: str = "text", size: int = 300,
             max_languages: int = 1000) -> dict[str, list[int]]:
    """The ``size`` most frequent n-grams of every language, counted over all rows with a language and a text.

    At most ``max_languages`` x ``size`` numbers come to the driver; more languages are an error.  Ties go to the
    smaller n-gram.
    """
    small_batches(labelled.sparkSession)
    rows = labelled.select(F.col(f"`{lang_col}`").cast("string").alias("lang"), F.col(f"`{text_col}`").alias("text"))
    rows = rows.where("lang IS NOT NULL AND text IS NOT NULL")
    counts = rows.mapInArrow(_counted, "lang string, gram long, n long").groupBy("lang", "gram").agg(
        F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.col("n").desc(), "gram")
    best = counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size)
    out: dict[str, list[int]] = {}
    for r in best.limit(max_languages * size + 1).collect():
        out.setdefault(r["lang"], [0] * size)[r["rank"] - 1] = r["gram"]
    if len(out) > max_languages:
        raise ValueError(f"More than {max_languages} languages.")
    return {lang: [g for g in grams if g] for lang, grams in sorted(out.items())}


def _predictions(learned: dict[str, list[int]], size: int):
    names = sorted(learned)
    known = np.unique(np.array([g for p in learned.values() for g in p], np.int64))
    ranks = np.full((len(known) + 1, len(names)), -1, np.int64)
    for k, name in enumerate(names):
        ranks[np.searchsorted(known, np.array(learned[name], np.int64)), k] = np.arange(len(learned[name]))

    def one(text):
        grams, n = grams_of(text) if text else ((), ())
        if not len(grams) or not names:
            return UNKNOWN, 0.0
        grams = grams[np.argsort(-n, kind="stable")[:size]]
        at = np.searchsorted(known, grams)
        at[(at == len(known)) | (known[np.minimum(at, len(known) - 1)] != grams)] = len(known)
        there = ranks[at]
        off = np.where(there < 0, size, np.abs(there - np.arange(len(grams))[:, None])).sum(axis=0)
        best = int(off.argmin())
        return names[best], 1.0 - float(off[best]) / (size * len(grams))

    def work(texts):
        got = [one(t) for t in texts]
        return {"lang": [g[0] for g in got], "score": [g[1] for g in got]}

    return work


def predicted(text: Column, learned: dict[str, list[int]], size: int = 300) -> Column:
    """Struct (lang, score) of a text column: the nearest language, and 1 less its share of the largest distance.

    ``und`` and 0 for a null text, one without a letter, or when nothing was learned.
    """
    return per_text(lambda: _predictions(learned, size), "lang string, score double", text)


def held_out(id_column: Column) -> Column:
    """Rows whose crc32 of the id as text leaves 2 when divided by 4; a null id does not."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             size: int = 300) -> DataFrame:
    """(id, held_out, lang_pred, score) of every row, learned from the rows that are not held out.

    Repeated rows count as often as they stand there; an empty table learns nothing and gives no rows.
    """
    learned = profiles(docs.where(~held_out(F.col(f"`{id_col}`"))), lang_col, text_col, size)
    rows = texts_of(docs, id_col, text_col)
    return rows.select("id", held_out(F.col("id")).alias("held_out"),
                       predicted(F.col("text"), learned, size).alias("p")).select(
        "id", "held_out", F.col("p.lang").alias("lang_pred"), "p.score")
