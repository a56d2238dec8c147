"""Entropy spans and masks against brute force, and the pipeline, stage by stage and as a whole, against plain Python."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from haulmark.llm import pieces, queries, secrets, toxicity
from haulmark.llm.common import cut, read, running
from tests.conftest import SF_DIR

LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def brute_spans(value):
    """(start, kind number, end) of all spans, window by window."""
    value = value or ""
    base = [(m.start(), 0, m.end()) for m in re.finditer(secrets.ASSIGN, value, re.ASCII) if len(m[2]) >= 6]
    base += [(m.start(), 1, m.end()) for m in re.finditer(secrets.ACCESS, value) if m.end() - m.start() >= 20]
    base += [(m.start(), 2, m.end()) for m in re.finditer(secrets.HEX, value) if m.end() - m.start() >= 24]
    found = list(base)
    for m in re.finditer(secrets.CANDIDATE, value):
        said = m[0]
        if not (re.search("[0-9]", said) and re.search("[A-Za-z]", said)) or re.search(secrets.ALLOWED, said, re.ASCII):
            continue
        for kind, (symbols, least) in secrets.CLASSES.items():
            hot = [i for i in range(len(said) - secrets.WINDOW + 1) if set(said[i:i + secrets.WINDOW]) <= set(symbols)
                   and -sum(c / secrets.WINDOW * math.log2(c / secrets.WINDOW) for c in Counter(said[i:i + secrets.WINDOW]).values()) >= least]
            if hot:
                span = m.start() + hot[0], secrets.KINDS.index(kind), m.start() + hot[-1] + secrets.WINDOW
                if not any(a <= span[0] and e >= span[2] for a, _, e in base):
                    found.append(span)
    return sorted(found)


def brute_mask(value):
    out, pos = "", -1
    for a, _, e in brute_spans(value):
        if a > pos:
            out += value[max(pos, 0):a] + secrets.MASK
        pos = max(pos, e)
    return out + value[max(pos, 0):] if value else value


def secret_texts():
    rng = random.Random(8)

    def some(alphabet, low, high):
        return "".join(rng.choice(alphabet) for _ in range(rng.randint(low, high)))
    parts = [lambda: some("abcde é.", 1, 60), lambda: some(LETTERS + "0123456789", 15, 60), lambda: some("0123456789abcdef", 15, 45),
             lambda: some("0123", 20, 40) + some("ab", 1, 30), lambda: "token=" + some(LETTERS + "0123456789", 3, 40),
             lambda: "AKIA" + some("ABCDEFGH234", 10, 30), lambda: some("ab1", 25, 40) + "😀" + some(LETTERS + "+/_=-7", 20, 50),
             lambda: some("01234567ab", 22, 40) + "/" + some("Qx9", 10, 50)]
    texts = [rng.choice((" ", "", "\n", "; ")).join(rng.choice(parts)() for _ in range(rng.randint(1, 12))) for _ in range(300)]
    key = some(LETTERS + "0123456789", 20_000, 20_000)
    many = " ".join(some("0123456789abcdef", 22, 30) if k % 5 == 0 else "wörd" for k in range(6_000))
    return texts + [key, many, "", " ", "a" * 70_000, "é" * 1025, "token=" + "a1" * 600 + " " + key[:64] * 3]


def test_spans_and_masks_against_brute_force(spark):
    texts = dict(enumerate(secret_texts())) | {9_999: None}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(8)
    out = {r["doc_id"]: r["all_spans"] for r in secrets.find(df).collect()}
    assert {k: [(s["start"], s["kind"], s["end"]) for s in v] for k, v in out.items()} == {k: brute_spans(v) for k, v in texts.items()}
    assert sum(s["kind"] >= 3 for v in out.values() for s in v) > 100
    assert {r["doc_id"]: r["text"] for r in secrets.redact(df).collect()} == {k: brute_mask(v) for k, v in texts.items()}


@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 5000])
def test_running_and_cut(spark, n):
    row = spark.range(1).select(running(F.expr(f"slice(sequence(1, 5000), 1, {n})"), F.lit(0), lambda at, x: at + x).alias("sums"),
                                cut(F.lit("é😀x\n" * n), F.expr(f"transform(slice(sequence(1, 5000), 1, {n // 3}), i -> struct(i * 5 AS a, i * 5 + 3 AS b))"),
                                    "|").alias("text")).first()
    assert row["sums"] == [k * (k + 1) // 2 for k in range(1, n + 1)]
    want, pos = "", 0
    for k in range(1, n // 3 + 1):
        want, pos = want + ("é😀x\n" * n)[pos:k * 5] + "|", k * 5 + 3
    assert row["text"] == want + ("é😀x\n" * n)[pos:]


CLASHING = ["score", "predicted", "toxic_tokens", "spans", "corpus_row", "node", "component", "n", "n_words", "word_from", "char_to",
            "items", "base_spans", "all_spans", "others", "list", "label with space"]


@pytest.fixture(scope="module")
def clashing(spark):
    """A few rows with columns of the operators' own names; each value says whose row it is."""
    texts = queries.read(spark, SF_DIR, "documents", "doc_id", "text").orderBy("doc_id").limit(6).collect()
    item = read(spark, SF_DIR, "benchmark", "item_id", "text").filter("text IS NOT NULL").orderBy("item_id").first()
    rows = [(r["doc_id"], r["text"]) for r in texts] + [(100_001, f"leak {item['text']} end"), (100_002, "key q8Zr2LmX9vB4nT7cK1wY5 end"), (100_003, None), (100_004, "")]
    values = [(i, t, *(f"{c} of {i}" if i % 2 else None for c in CLASHING)) for i, t in rows]
    return spark.createDataFrame(values, "doc_id long, text string, " + ", ".join(f"`{c}` string" for c in CLASHING)), {v[0]: v[2:] for v in values}


@pytest.mark.parametrize("name,apply", corpus_pipeline.STAGES[:-1])
def test_stages_keep_the_callers_columns(spark, clashing, name, apply):
    df, values = clashing
    out = apply(spark, df, SF_DIR)
    assert out.columns == df.columns
    got = out.collect()
    assert {100_002, 100_003, 100_004} <= {r["doc_id"] for r in got}
    for r in got:
        assert tuple(r)[2:] == values[r["doc_id"]]


@pytest.mark.parametrize("name,apply", corpus_pipeline.STAGES)
def test_stages_of_empty_tables(spark, clashing, name, apply):
    assert apply(spark, clashing[0].limit(0), SF_DIR).count() == 0


def folded(value):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in value or "")


def brute_near_copies(docs):
    """The ids that stay: every pair of documents is compared."""
    sets = {}
    for i, value in docs.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", folded(value))
        if words:
            sets[i] = {tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))}
    up = {i: i for i in docs}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i
    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            shared = len(sets[a] & sets[b])
            if 100 * shared >= 80 * (len(sets[a]) + len(sets[b]) - shared):
                low, high = sorted((top(a), top(b)))
                up[high] = low
    return {i for i in docs if top(i) == i}


def brute_cut(value, windows):
    places = list(re.finditer(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", folded(value)))
    words = [m[0] for m in places]
    hit = set()
    for size in {len(w) for w in windows}:
        for k in range(len(words) - size + 1):
            if tuple(words[k:k + size]) in windows:
                hit.update(range(k, k + size))
    out, pos = "", 0
    for k in sorted(hit):
        if k - 1 not in hit:
            out += value[pos:places[k].start()]
        pos = places[k].end()
    return out + value[pos:] if value else value


def test_pipeline_against_plain_python(spark, tmp_path):
    """On documents of a larger input, toxic ones among them: the smallest input has too few labels for any to be rejected."""
    larger, sf_dir = SF_DIR.replace("sf0.001", "sf0.01"), str(tmp_path)
    labels = read(spark, larger, "labels", "doc_id", "toxic")
    docs = spark.read.parquet(f"{larger}/documents.parquet").join(labels.filter("toxic = 1").select("doc_id", "toxic"), "doc_id", "left")
    docs.filter("toxic IS NOT NULL OR doc_id < 250").drop("toxic").write.parquet(f"{sf_dir}/documents.parquet")
    labels.write.parquet(f"{sf_dir}/labels.parquet")
    read(spark, larger, "benchmark", "item_id", "text").write.parquet(f"{sf_dir}/benchmark.parquet")
    docs, labels, benchmark = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels", "benchmark"))

    scored = toxicity.toxicity(docs, labels).collect()
    kept = {r["doc_id"]: r["text"] for r in scored if r["predicted"] == 0}
    assert 0 < len(kept) < len(scored)
    first = brute_near_copies(kept)
    assert len(first) < len(kept)
    windows = set()
    for r in benchmark.collect():
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", folded(r["text"]))
        windows |= {tuple(words[k:k + 10]) for k in range(max(1, len(words) - 9)) if words}
    clean = {i: brute_mask(brute_cut(kept[i], windows)) for i in first}
    assert any(clean[i] != kept[i] for i in first)
    want = pieces.encode(spark.createDataFrame(list(clean.items()), "doc_id long, text string"), queries.piece_model()).drop("text")
    got = corpus_pipeline.run(spark, sf_dir)
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))
