import hashlib

import pytest
import xxhash
from pyspark.sql import functions as F

from quillmark.llm import simhash
from quillmark.llm.common import read
from tests.llm import edges


def fingerprint(text):
    """The 128 bits by counting votes one by one."""
    words = []
    for w in __import__("re").split("[\\x20\\x09-\\x0D]+", text.lower()):
        words.append(w)
    # Leaving out null neighbours, the last word stands alone.
    terms = words if len(words) == 1 else [" ".join(words[i : i + 2]) for i in range(len(words))]
    total, votes = 0, [0] * 128
    for t in terms:
        w = min(len(t), simhash.MAX_WEIGHT)
        total += w
        first = xxhash.xxh64_intdigest(t.encode(), 42)
        # The second hash starts from the hash of the integer 1.
        seed = xxhash.xxh64_intdigest((1).to_bytes(4, "little"), 42)
        second = xxhash.xxh64_intdigest(t.encode(), seed)
        for k in range(64):
            votes[k] += w * (first >> k & 1)
            votes[64 + k] += w * (second >> k & 1)
    bits = [int(2 * v > total) for v in votes]
    value = lambda part: sum(b << k for k, b in enumerate(part))
    return f"{value(bits[:64]):016x}{value(bits[64:]):016x}"


def expected(rows):
    rows = sorted(rows, key=lambda r: (-(r["doc_id"] if r["doc_id"] is not None else -(2**63)), (r["text"] or "").encode()))
    out = []
    for k, r in enumerate(rows):
        text, after = r["text"] or "", rows[(k + 1) % len(rows)]["text"] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        prints = [fingerprint(x) for x in (text, edited, after)]
        like = lambda a, b: 1 - (int(a, 16) ^ int(b, 16)).bit_count() / 128
        out.append(
            (r["doc_id"], len(text), hashlib.sha256(edited.encode()).hexdigest(), prints[0], prints[1], like(*prints[:2]), like(prints[0], prints[2]))
        )
    return out


@pytest.mark.parametrize("source", ["table", "edges"])
def test_same_as_counting_votes(spark, sf, source):
    docs = read(spark, sf, "documents") if source == "table" else edges.documents(spark)
    rows = simhash.edited_fingerprints(docs).drop("f0", "f1").collect()
    order = lambda rows: sorted(map(tuple, rows), key=lambda r: (r[0] is None, r[0] or 0, r[1:]))
    assert order(rows) == order(expected(docs.collect()))


def test_empty_table(spark):
    assert simhash.edited_fingerprints(edges.no_documents(spark)).count() == 0


@pytest.mark.parametrize("n_blocks", [4, 6])
def test_search_finds_all_within_the_radius(spark, n_blocks):
    chance = __import__("random").Random(n_blocks)
    base = [chance.getrandbits(128) for _ in range(40)]
    prints = [b ^ sum(1 << k for k in chance.sample(range(128), chance.randint(0, 6))) for b in base for _ in range(12)]
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    half = lambda v: (signed(v >> 64), signed(v & (1 << 64) - 1))
    df = spark.createDataFrame([half(v) for v in prints], "f0 bigint, f1 bigint")
    found = {(r.q0, r.q1, r.f0, r.f1) for r in simhash.within(df, df, 3, n_blocks).collect()}
    distinct = set(prints)
    assert found == {(*half(a), *half(b)) for a in distinct for b in distinct if (a ^ b).bit_count() <= 3}


def test_no_python_on_the_main_path(spark, sf):
    plan = simhash.edited_fingerprints(read(spark, sf, "documents"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    bounds = list(range(0, 1000, 7))
    ids = spark.range(-5, 1010).withColumn("b", simhash.bucket_of(F.col("id"), bounds))
    assert all(r.b == sum(x <= r.id for x in bounds) for r in ids.collect())
