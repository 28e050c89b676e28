"""Operators 11 to 13 against the library, against plain Python, and on odd rows."""

import hashlib
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from conftest import odd_texts
from deskflow.llm import middle, periodic, pieces
from deskflow.llm.queries import op11_pieces, op12_middle, op13_periods

MODEL = public_tokenizers.path("piece_bpe_32k.model")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def codec():
    return pieces.Codec(pieces.read_model(MODEL), memory=1 << 16)


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


# ---- operator 11 ----------------------------------------------------------------------------------------

@pytest.mark.parametrize("alphabet", ["ab", "abcdefgh ", "aaab▁ ", "the quick brown fox ", "日本語é ☃", "0123456789 .,", "\n\t \0ab", "ſßİı ﬁ"])
def test_pieces_of_random_texts(codec, library, alphabet):
    rnd = random.Random(alphabet)
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(400))) for _ in range(40)]
    for text, ids in zip(texts, codec.encode(texts)):
        want = library.encode(text, add_bos=True, add_eos=True)
        assert np.frombuffer(ids, "<u4").tolist() == want and codec.decode(ids) == library.decode(want)


def test_decode_any_ids(codec, library):
    rnd = random.Random(2)
    few = [0, 1, 2, 35, 230, 132, 133, 258, 259, 29871]
    for _ in range(2000):
        ids = [rnd.choice([*few, rnd.randrange(32000)]) for _ in range(rnd.randrange(8))]
        assert codec.decode(np.array(ids, "<u4").tobytes()) == library.decode(ids)


def test_a_long_word(codec, library):
    rnd = random.Random(3)
    text = "".join(rnd.choice("abcdefghijklmnopqrstuvwxyzABC+/") for _ in range(60_000))
    assert np.frombuffer(codec.encode([text])[0], "<u4").tolist() == library.encode(text, add_bos=True, add_eos=True)


def test_other_models_are_refused(tmp_path):
    with open(MODEL, "rb") as f:
        data = f.read()
    # A second trainer part wins: model type 1, no merges.
    (tmp_path / "m").write_bytes(data + b"\x12\x02\x18\x01")
    with pytest.raises(ValueError):
        pieces.read_model(str(tmp_path / "m"))


def test_op11(spark, library):
    rows = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = op11_pieces(spark, SF).collect()
    assert len(got) == len(rows)
    for r in got:
        ids = library.encode(rows[r["doc_id"]], add_bos=True, add_eos=True)
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), sha(np.array(ids, "<u4").tobytes()))
        assert r["decoded_sha256"] == sha(library.decode(ids))


def test_pieces_of_odd_rows(odd, library):
    want = Counter()
    for r in odd.select("doc_id", "text").collect():
        ids = library.encode(r["text"] or "", add_bos=True, add_eos=True)
        want[r["doc_id"], len(ids), np.array(ids, "<u4").tobytes(), library.decode(ids)] += 1
    got = pieces.encode_decode(odd.repartition(3), MODEL, memory=1 << 12).collect()
    assert Counter((r["id"], r["n_tokens"], bytes(r["ids"]), r["decoded"]) for r in got) == want
    assert pieces.encode_decode(odd.limit(0), MODEL).collect() == []


# ---- operator 12 ----------------------------------------------------------------------------------------

UNIT = re.compile("[\x20\x09-\x0d]*[^\x20\x09-\x0d]+|[\x20\x09-\x0d]+")


def cut_plainly(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return n, "plain", None, None, text
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 80:
        return n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


@pytest.mark.parametrize("block", [1, 7, 64, 1024])
def test_cuts(block):
    rnd = random.Random(block)
    texts = [t or "" for t in odd_texts()]
    texts += ["".join(rnd.choice("ab é\n😀 ") for _ in range(rnd.randrange(300))) for _ in range(60)]
    data = [t.encode() for t in texts]
    high = np.cumsum([len(d) for d in data])
    low = high - [len(d) for d in data]
    units = middle.Units(np.frombuffer(b"".join(data), np.uint8), low, high, block)
    split = [UNIT.findall(t) for t in texts]
    assert units.n.tolist() == [len(u) for u in split]
    for share in (0, 0.3, 0.5, 1):
        wanted = (units.n * share).astype(int)
        size, points = units.cut(np.arange(len(texts)), wanted)
        head = ["".join(u[:k]) for u, k in zip(split, wanted.tolist())]
        assert size.tolist() == [len(x.encode()) for x in head] and points.tolist() == [len(x) for x in head]


def test_middle_of_odd_rows(spark, odd):
    marked = spark.createDataFrame([(100 + i, t) for i, t in enumerate(
        ["a <P> b", "x<S>", "<M>", "<P", "S> <", " lead and trail \n"] * 12)], "doc_id long, text string")
    rows = odd.select("doc_id", "text").union(marked)
    want = Counter((r["doc_id"], *cut_plainly(*r)) for r in rows.collect())
    made = middle.fill_in_middle(rows.repartition(4), block=16)
    assert Counter(map(tuple, made.collect())) == want and {f for _, _, f, *_ in want} == {"plain", "spm", "psm"}
    back = made.select("id", middle.restored(made["form"], made["output"]))
    assert Counter(map(tuple, back.collect())) == Counter((r["doc_id"], r["text"] or "") for r in rows.collect())
    assert middle.fill_in_middle(odd.limit(0)).collect() == []
    assert middle.fill_in_middle(odd).count() == odd.count()


def test_op12(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = Counter()
    for r in rows:
        *facts, out = cut_plainly(*r)
        want[(r["doc_id"], *facts, sha(out), sha(r["text"] or ""))] += 1
    assert Counter(map(tuple, op12_middle(spark, SF).collect())) == want


# ---- operator 13 ----------------------------------------------------------------------------------------

def runs_plainly(w, least=24, times=3):
    out = {}
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, times * q):
                out.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, e - s, q) for (s, e), q in out.items())


def collapsed(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def random_words(rnd):
    letters = "abcdefghijklmnopqrstuvwxyz"[:rnd.choice([1, 2, 2, 3, 4, 26])]
    out = []
    for _ in range(rnd.randrange(5)):
        p = rnd.choices(letters, k=rnd.choice([1, 2, 3, 5, 7, 8, 9, 15, 16, 17, 31, 33, 40]))
        if rnd.random() < 0.4:
            p = p * 3 + rnd.choices(letters, k=rnd.randrange(3))
        out += rnd.choices(letters, k=rnd.randrange(10)) + (p * 12)[:rnd.randrange(1, 300)]
    return out


def test_runs_of_random_words():
    rnd = random.Random(5)
    work = periodic._found(24, 3)
    some = 0
    for _ in range(150):
        texts = [random_words(rnd) for _ in range(rnd.randrange(1, 6))]
        got = work([" ".join(w) for w in texts])
        for w, n, runs, left in zip(texts, got["n"], got["runs"], got["collapsed"]):
            want = runs_plainly(w)
            assert n == len(w) and [(r["start"], r["length"], r["period"]) for r in runs] == want
            assert left == collapsed(w, want)
            some += len(want)
    assert some > 500


def test_range_successor():
    rnd = np.random.default_rng(1)
    for n in (1, 2, 63, 64, 65, 1000):
        values = rnd.permutation(n)
        tree = periodic.Wavelet(values)
        a, b = np.sort(rnd.integers(0, n + 1, (2, 300)), axis=0)
        least = rnd.integers(0, n + 3, 300)
        want = [min([v for v in values[i:j].tolist() if v >= x], default=n) for i, j, x in zip(a, b, least)]
        assert tree.successor(a, b, least).tolist() == want


def test_smaller_limits_are_refused():
    with pytest.raises(ValueError):
        periodic.periodic_runs(np.zeros(3, int), np.array([2]), least=12)


def planted(doc_id, text):
    w = re.findall("[^\x20\x09-\x0d]+", text or "")
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and w:
        g = h // 10
        a = g % len(w)
        p = 1 + (len(w) - a) // (3 + g % 8)
        w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
    return w


def test_op13(spark):
    got = {r["doc_id"]: r for r in op13_periods(spark, SF).collect()}
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    short = [r for r in rows if len(r["text"] or "") < 20_000]
    assert len(got) == len(rows) and len(short) > 190
    for r in short:
        w = planted(*r)
        runs = runs_plainly(w)
        best = min(runs, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=(None,) * 3)
        mine = got[r["doc_id"]]
        assert (mine["n_runs"], mine["start"], mine["length"], mine["period"]) == (len(runs), *best)
        assert mine["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)
        assert mine["runs_sha256"] == sha("".join(f"{s},{n},{q}\n" for s, n, q in runs))
        assert mine["collapsed_sha256"] == sha(collapsed(w, runs))


def test_periods_of_odd_rows(odd):
    got = Counter((r["id"], r["n"], tuple((x["start"], x["length"], x["period"]) for x in r["runs"]), r["collapsed"])
                  for r in periodic.repeated_periods(odd.repartition(3)).collect())
    want = Counter()
    for r in odd.select("doc_id", "text").collect():
        w = re.findall("[^\x20\x09-\x0d]+", r["text"] or "")
        runs = runs_plainly(w)
        want[r["doc_id"], len(w), tuple(runs), collapsed(w, runs)] += 1
    assert got == want and any(runs for _, _, runs, _ in want)
    assert periodic.repeated_periods(odd.limit(0)).collect() == []
