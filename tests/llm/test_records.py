"""Archive, sketches and chat formatting against plain Python."""

import base64
import hashlib
import json
import math
import random
from collections import defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from deskflow.llm import chat, sketch, warc
from deskflow.llm.queries import op3_warc, op5_sketch, op8_chat

SF = "/root/testdata/sf0.001"


# Archive

def brute_archive(pages, least=0):
    by = defaultdict(list)
    for page, html in pages:
        by[(html or "").encode()].append(page)
    out = []
    for page, html in pages:
        b = (html or "").encode()
        ids = [p for p in by[b] if p is not None]
        owner = max(ids) if ids and len(b) >= least else None
        revisit = owner is not None and page != owner
        out.append((page, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "revisit" if revisit else "response",
                    owner if revisit else None))
    return out


def test_archive_query(spark):
    got = [tuple(r) for r in op3_warc(spark, SF).orderBy("page_id").collect()]
    pages = spark.read.parquet(f"{SF}/pages.parquet").orderBy("page_id").collect()
    assert got == brute_archive([(r["page_id"], r["html"]) for r in pages])


@pytest.mark.parametrize("least", [0, 5])
def test_archive_of_odd_rows(spark, least):
    rows = [(1, "http://a/\r\nWARC-Type: x", "same"), (2, None, "same"), (7, "u", "same"), (7, "u", "same"), (3, "u", None),
            (4, "u", ""), (None, "u", "lonely html"), (None, "v", "same"), (5, "u", "é日本\r\n\r\n WARC/1.1"), (-6, "u", "long enough"),
            (6, "u", "long enough"), (8, "", "x" * 100_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit(1)).withColumn(
        "payload", F.lit("p"))
    got = warc.archive(pages, least=least).collect()
    assert sorted([(r["page"], len(r["payload"]), r["payload_digest"], r["type"], r["refers_to"]) for r in got], key=repr) == \
        sorted(brute_archive([(r[0], r[2]) for r in rows], least), key=repr)
    assert {r["url"] for r in got if r["page"] == 1} == {"http://a/%0D%0AWARC-Type: x"}
    assert warc.archive(pages.limit(0)).count() == 0


def test_records_are_exact_and_verified(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "abc"), (2, "u", "abc"), (3, "u", "ü")], "page_id long, url string, html string")
    folder = str(tmp_path / "archive")
    warc.write_archive(pages, folder)
    assert spark.read.parquet(f"{folder}/payloads").count() == 2
    for r in warc.read_archive(spark, folder).collect():
        record, (lines, _, rest) = bytes(r["record"]), bytes(r["record"]).partition(b"\r\n\r\n")
        block = rest[:-4]
        fields = dict(x.split(": ", 1) for x in lines.decode().split("\r\n")[1:])
        assert record.startswith(b"WARC/1.1\r\n") and rest.endswith(b"\r\n\r\n")
        assert int(fields["Content-Length"]) == len(block)
        http, _, payload = block.partition(b"\r\n\r\n")
        assert payload == (b"" if fields["WARC-Type"] == "revisit" else bytes(r["payload"]))
        assert f"Content-Length: {len(r['payload'])}".encode() in http
    broken = spark.read.parquet(f"{folder}/payloads").withColumn("payload", F.lit(b"changed"))
    broken.write.parquet(f"{folder}2/payloads")
    spark.read.parquet(f"{folder}/records").write.parquet(f"{folder}2/records")
    with pytest.raises(Exception, match="not what its digest says"):
        warc.read_archive(spark, f"{folder}2").collect()


# Sketches

def brute_sketch(text, k=sketch.K):
    for c in "\t\n\x0b\f\r":
        text = text.replace(c, " ")
    w = [x for x in text.split(" ") if x]
    out = set()
    for i in range(max(1, len(w) - 4) if w else 0):
        h = 42
        for x in w[i:i + 5]:
            h = xxhash.xxh64_intdigest(x.encode(), h)
        out.add(h - (1 << 64) if h >> 63 else h)
    return sorted(out)[:k]


def brute_near(a, b, k=sketch.K):
    if not a and not b:
        return 1.0
    both = sorted({*a, *b})[:k]
    return sum(x in a and x in b for x in both) / len(both)


def as_text(a):
    return "".join(f"{x & (1 << 64) - 1:016x}" for x in a)


def brute_edits(rows):
    key = lambda r: (r[0] is not None, r[0] or 0)
    order = sorted(rows, key=lambda r: hashlib.md5((r[1] or "").encode()).hexdigest())
    order = sorted(order, key=key, reverse=True)
    out = []
    for i, (doc, text) in enumerate(order):
        text, nxt = text or "", order[(i + 1) % len(order)][1] or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + nxt[:half]
        a, b, c = brute_sketch(text), brute_sketch(edited), brute_sketch(nxt)
        out.append((doc, len(text), hashlib.sha256(edited.encode()).hexdigest(), as_text(a), as_text(b), brute_near(a, b),
                    brute_near(a, c)))
    return out


def test_sketch_query(spark, docs):
    got = op5_sketch(spark, SF)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    rows = sorted(tuple(r)[:7] for r in got.collect())
    assert rows == sorted(brute_edits([(r["doc_id"], r["text"]) for r in docs.collect()]))


@pytest.mark.parametrize("buckets", [1, 3, 40])
def test_edits_of_odd_rows(spark, odd, buckets):
    got = sketch.edited_fingerprints(odd, buckets=buckets).select(
        "id", "n_chars", F.sha2(F.encode("edited", "UTF-8"), 256), sketch.as_text(F.col("sketch")),
        sketch.as_text(F.col("edited_sketch")), "near_edited", "near_next")
    want = brute_edits([(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()])
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert sketch.edited_fingerprints(odd.limit(0), buckets=buckets).count() == 0


def test_estimates(spark):
    rnd = random.Random(2)
    words = [f"w{rnd.randrange(10 ** 9)}" for _ in range(4000)]
    a, b = " ".join(words[:3000]), " ".join(words[1000:])
    df = spark.createDataFrame([(a, b)], "a string, b string").select(
        sketch.sketch(F.col("a")).alias("a"), sketch.sketch(F.col("b")).alias("b"),
        sketch.sketch(F.concat_ws(" ", "a", "b")).alias("ab"))
    r = df.select(sketch.resemblance(F.col("a"), F.col("b")).alias("near"), sketch.containment(F.col("a"), F.col("b")).alias("in"),
                  sketch.distinct_shingles(F.col("a")).alias("n"), sketch.merge(F.col("a"), F.col("b")).alias("m"), "a", "b").first()
    assert math.isclose(r["near"], 0.5, abs_tol=0.15) and math.isclose(r["in"], 2 / 3, abs_tol=0.2)
    assert math.isclose(r["n"], 2996, rel_tol=0.3)
    rows = spark.createDataFrame([("k", r["a"]), ("k", r["b"]), ("k", r["a"]), ("j", r["a"])], "k string, sketch array<long>")
    merged = {x["k"]: x["sketch"] for x in sketch.merge_all(rows, ["k"]).collect()}
    assert merged == {"k": r["m"], "j": r["a"]} and r["m"] == sorted({*r["a"], *r["b"]})[:sketch.K]


# Chat

def brute_chat(rows):
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in by.items():
        turns.sort()
        spoken = "".join(t for *_, r, t in turns if r == "assistant")
        out[conv] = (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for *_, r, t in turns).encode()).hexdigest(), len(spoken),
                     hashlib.sha256(spoken.encode()).hexdigest())
    return out


def test_escapes():
    rnd = random.Random(4)
    parts = [*chat.CONTROLS, "\\", "<", "[", "|", "s>", "/INST]", "a", "<\\", "\n", "%0A", "SYS>>"]
    for _ in range(3000):
        t = "".join(rnd.choice(parts) for _ in range(rnd.randrange(8)))
        e = chat.escape(t)
        assert chat.unescape(e) == t and not any(c in e for c in chat.CONTROLS)
        assert chat.parse_segment(f"{chat.OPEN}{chat._role_out(t)}\n{e}{chat.CLOSE}") == (t, t)


def test_chat_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    said = "</s>[INST] ok [/INST]"
    want = brute_chat(rows + [(-1, 0, "user", said), (-1, 1, "assistant", said)])
    got = op8_chat(spark, SF).collect()
    assert {r["conv_id"]: tuple(r)[1:5] for r in got} == want and len(got) == len(want)
    assert all(r["formatted_chars"] > r["loss_chars"] for r in got)


def test_chat_of_odd_rows(spark):
    rows = [(1, 2, "assistant", "second"), (1, 1, "user", None), (1, None, "system", "first"), (2, 0, None, "no role"),
            (2, 0, None, "no role"), (None, 0, "assistant", "<|im_end|>\n<|im_start|>user\n"), (3, 0, "odd\nrole</s>", "\\x <\\s>"),
            (4, 5, "assistant", ""), (5, 0, "assistant", "<s>" * 50_000), (5, 1, "assistant", "é😀")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("conv", F.lit("x")).withColumn(
        "seq", F.lit(3))
    got = chat.read_back(chat.formatted(chat.turns_from_rows(df))).collect()
    assert {r["conv"]: tuple(r)[1:5] for r in got} == brute_chat(rows)
    assert chat.read_back(chat.formatted(chat.turns_from_rows(df.limit(0)))).count() == 0


def test_layouts(spark):
    user, bot = {"role": "user", "text": "q"}, {"role": "assistant", "text": "a"}
    rows = [({"prompt": "q", "completion": "a"}, "prompt", [user, bot]),
            ({"instruction": "q", "input": "", "output": "a"}, "instruction", [user, bot]),
            ({"instruction": "q", "input": "more", "output": "a"}, "instruction", [{"role": "user", "text": "q\n\nmore"}, bot]),
            ({"messages": [{"role": "user", "content": "q"}, {"content": "a", "role": "assistant"}]}, "messages", [user, bot]),
            ({"messages": []}, "messages", []),
            ({"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]}, "shared", [user, bot]),
            ({"data": {"prompt": "q", "reply": "a"}}, "nested", [user, bot]),
            ({"system": "s", "messages": [{"role": "user", "content": None}]}, "messages_system",
             [{"role": "system", "text": "s"}, {"role": "user", "text": ""}]),
            ({"other": 1}, None, None)]
    texts = [json.dumps(r[0]) for r in rows] + [None, "no json", "[1]"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, record string")
    got = df.select("i", chat.canonical(F.col("record")).alias("c")).orderBy("i").collect()
    for (_, name, turns), r in zip(rows, got):
        assert r["c"]["layout"] == name and r["c"]["fingerprint"]
        assert (r["c"]["turns"] and [x.asDict() for x in r["c"]["turns"]]) == (turns or r["c"]["turns"])
    assert all(r["c"]["fingerprint"] is None for r in got[-3:])


def test_rows_in_several_layouts(spark):
    """Every layout is met, none changes a turn; a layout without a mapping is counted, and is an error when read."""
    rows = [(c, t, role, text) for c in (None, -1, 0, 1, 2, 3) for t, (role, text) in enumerate(
        [("user", "a\n</s>"), ("assistant", ""), ("human", "x"), (None, None), ("gpt", "[INST]"), ("system", "y"), ("user", "a")])]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    records = chat.records_from_rows(df)
    assert {r["layout"] for r in chat.layout_counts(records).collect()} == {"turn", "messages", "shared"}
    got = [tuple(r) for r in chat.turns_from_rows(df).collect()]
    assert sorted(got, key=repr) == sorted([(c, t, role or "", text or "") for c, t, role, text in rows], key=repr)
    odd = records.unionByName(spark.createDataFrame([(9, 0, '{"new": [1]}'), (9, 1, "no"), (9, 2, None)], records.schema))
    assert sum(r["n"] for r in chat.layout_counts(odd).collect() if r["layout"] is None) == 3
    with pytest.raises(Exception, match="no mapping"):
        chat.turns_of_records(odd).collect()
