"""Every operator on small made-up rows, against brute force, with nulls, empty texts, repeats and empty tables."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from haulmark.llm import (chat, coder, decontaminate, embeddings, licenses, ngram_join, passages, pieces, secrets, text,
                          token_files, toxicity)

public_tokenizers = pytest.importorskip("public_tokenizers")
DOCS = "doc_id long, text string"
ODD = [(None, "no id here"), (900, None), (901, ""), (902, " \n "), (902, " \n "), (903, "é" * 30_000)]


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefgé") for _ in range(rng.randint(2, 7))) for _ in range(n))


def docs(spark, rows):
    """With a further column whose name an operator adds."""
    return spark.createDataFrame([(*r, "kept") for r in rows], DOCS + ", score string")


def test_words_and_shingles():
    values = ["Ab ab  AB", "", "x", "Ünï c0de!"]
    (_, _, data, offsets), = text.pieces(pa.array(values))
    found = text.words(data, offsets, text.ALNUM)
    assert np.diff(found.bounds).tolist() == [3, 0, 1, 2]
    assert len(set(found.hashes[:3].tolist())) == 1
    assert np.diff(text.shingles(found, 3)[1]).tolist() == [1, 0, 1, 1]
    assert np.diff(text.shingles(found, 3, short=False)[1]).tolist() == [1, 0, 0, 0]


def test_toxicity(spark):
    rng = random.Random(5)
    rows = [(k, prose(k, 40) + (f" mudface{rng.choice('abcd')} oaf " if k % 3 == 0 else " ") + prose(k + 5000, 20)) for k in range(300)]
    labels = spark.createDataFrame([(k, int(k % 3 == 0)) for k, _ in rows] + [(None, 1), (5, None)], "doc_id long, toxic int")
    out = {r["doc_id"]: r for r in toxicity.toxicity(docs(spark, rows + ODD), labels).collect()}
    held = [k for k, _ in rows if zlib.crc32(str(k).encode()) % 3 == 1]
    assert all(out[k]["predicted"] == (k % 3 == 0) for k in held)
    assert 0 <= out[901]["score"] < 0.7 and out[900]["spans"] == ""
    start, end = map(int, out[held[0] if held[0] % 3 == 0 else next(k for k in held if k % 3 == 0)]["spans"].split(",")[0].split(":"))
    assert end > start
    assert toxicity.toxicity(docs(spark, []), labels.limit(0)).count() == 0


def test_chain_marginals():
    model = toxicity.Model(np.zeros((3, 1 << 18)), moves=np.array([[0.3, -1.0], [0.2, 0.7]]), opening=np.array([0.1, -0.4]))
    energy, first = np.array([0.5, -1.0, 2.0, 0.1, -0.3]), np.array([True, False, False, True, False])
    ahead, behind = toxicity._chain(energy, first, model)
    p = ahead * behind / (ahead * behind + (1 - ahead) * (1 - behind))
    want = np.zeros(5)
    for lo, hi in ((0, 3), (3, 5)):
        total, part = 0.0, np.zeros(hi - lo)
        for bits in range(1 << (hi - lo)):
            y = [(bits >> k) & 1 for k in range(hi - lo)]
            weight = np.exp(model.opening[y[0]] + sum(energy[lo + k] * y[k] for k in range(hi - lo))
                            + sum(model.moves[y[k], y[k + 1]] for k in range(hi - lo - 1)))
            total, part = total + weight, part + weight * np.array(y)
        want[lo:hi] = part / total
    assert np.allclose(p, want)


def test_secrets(spark):
    key = "q8Zr2LmX9vB4nT7cK1wY5"
    rows = [(1, f'é token = "abcdef12345" AKIA{"B7" * 9} x'), (2, "password=short"), (3, "password: abc"), (4, f"id {key} end"),
            (5, "fe" * 12 + " " + "0" * 30), (6, "API-KEY apikey:aaaaaa passwd='bbbbbb'"), (7, "example" + key)]
    out = {r["doc_id"]: r for r in secrets.report(docs(spark, rows + ODD)).collect()}
    for k, value in rows + [(901, "")]:
        base = [(m.start(), "assign", m.end()) for m in re.finditer(secrets.ASSIGN, value, re.ASCII) if len(m[2]) >= 6]
        base += [(m.start(), "access", m.end()) for m in re.finditer(secrets.ACCESS, value) if m.end() - m.start() >= 20]
        base += [(m.start(), "hex", m.end()) for m in re.finditer(secrets.HEX, value) if m.end() - m.start() >= 24]
        said = ",".join(f"{kind}:{a}:{b}" for a, kind, b in sorted(base, key=lambda s: (s[0], secrets.KINDS.index(s[1]))))
        assert out[k]["base_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        assert out[k]["n_assign"] == sum(s[1] == "assign" for s in base)
    assert out[4]["spans"] == f"entropy_mixed:3:{3 + len(key)}" and out[7]["spans"] == ""
    masked = {r["doc_id"]: r["text"] for r in secrets.redact(docs(spark, rows + ODD)).collect()}
    assert masked[4] == "id [SECRET] end" and masked[900] is None and masked[2] == "password=short"


def test_ngram_join(spark):
    base = prose(1, 80).split()
    near = base[:40] + ["changed"] + base[41:]
    rows = [(1, " ".join(base)), (2, " ".join(near)), (3, " ".join(base).upper()), (4, prose(9, 80)), (5, "one two"), (6, "ONE two"), (7, "one")]
    out = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in ngram_join.report(docs(spark, rows)).collect())

    def shingles(value):
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in value))
        return {tuple(w[k:k + 3]) for k in range(max(1, len(w) - 2))} if w else set()
    sets = {k: shingles(v) for k, v in rows}
    component = {k: k for k in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                if 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b]):
                    component[a] = component[b] = min(component[a], component[b])
    assert out == sorted((k, len(sets[k]), component[k]) for k in sets)
    odd = {r["doc_id"]: r for r in ngram_join.report(docs(spark, ODD)).collect()}
    assert odd[902]["n_shingles"] == 0 and odd[902]["component_id"] == 902 and odd[None]["component_id"] is None
    assert ngram_join.report(docs(spark, [])).count() == 0


def test_parities_lose_nothing():
    """Parities of different widths never show more differences than the sets have."""
    rng = np.random.default_rng(8)
    sets = [np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64)) for n in (0, 1, 255, 256, 257, 3000)]
    sets += [np.sort(np.concatenate([sets[-1][k:], sets[3][:k]])) for k in (0, 1, 100, 256)]
    bounds = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    held = ngram_join._parities(np.concatenate(sets), bounds).to_pylist()
    assert [len(h) for h in held[:6]] == [0, 32, 32, 32, 64, 512]
    for x, a in zip(sets, held):
        for y, b in zip(sets, held):
            if len(a) and len(b):
                differ = len(np.setxor1d(x, y))
                assert ngram_join._differing(a, b) <= differ and ngram_join._differing(a, b) % 2 == differ % 2


def test_ngram_join_of_a_large_group(spark):
    """A chain-like group of near copies of one text, with a common line in all texts, against brute force."""
    rng = random.Random(12)
    base, line = prose(700, 70).split(), prose(701, 6)
    texts = []
    for _ in range(220):
        words = list(base)
        for k in rng.sample(range(len(words)), rng.randint(0, 3)):
            words[k] = f"new{rng.randint(0, 30)}"
        texts.append(" ".join(words) + " " + line)
    texts += [prose(800 + k, 60) + " " + line for k in range(60)]
    sets = [{tuple(w[k:k + 3]) for k in range(len(w) - 2)} for w in map(str.split, texts)]
    want = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if 100 * both >= 90 * (len(sets[a]) + len(sets[b]) - both) and want[a] != want[b]:
                low, high = sorted((want[a], want[b]))
                want = [low if c == high else c for c in want]
    out = {r["doc_id"]: r["component_id"] for r in ngram_join.report(docs(spark, list(enumerate(texts)))).collect()}
    assert [out[k] for k in range(len(texts))] == want and 1 < len(set(want[:220])) < 220


def test_pairs_of_a_large_group_of_near_copies(spark, monkeypatch):
    """Texts with one or two words changed link to a part of the group each: what is searched exactly stays near their number."""
    random.seed(29)
    line, texts = [f"w{i}" for i in range(150)], []
    for k in range(240):
        words = list(line)
        for at in random.sample(range(150), 2 if k % 3 else 1):
            words[at] = f"x{random.random()}"
        texts.append(" ".join(words))
    counted, rest = [], ngram_join._rest

    def search(*args):
        found = rest(*args)
        counted.append(found.count())
        return found
    monkeypatch.setattr(ngram_join, "_rest", search)
    out = {r["doc_id"]: r["component_id"] for r in ngram_join.report(docs(spark, list(enumerate(texts)))).collect()}
    assert out == _components_by_brute_force(texts)
    assert counted[0] <= len(texts)


def _components_by_brute_force(texts):
    sets = [{tuple(w[i:i + 3]) for i in range(len(w) - 2)} for w in (t.split() for t in texts)]
    root = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            if 10 * len(sets[a] & sets[b]) >= 9 * len(sets[a] | sets[b]):
                low, high = sorted((root[a], root[b]))
                root = [low if r == high else r for r in root]
    return dict(enumerate(root))


def test_near_copies_are_rows(spark):
    """Repeated rows of one id, copies without id, and a clean row that has the id of a copy."""
    from corpus_pipeline import drop_near_copies
    a, b, c, d = (prose(400 + k, 60) for k in range(4))
    rows = [(1, a), (2, a), (2, b), (3, c), (3, c), (None, d), (None, d), (4, ""), (4, ""), (None, a)]
    kept = drop_near_copies(spark, docs(spark, rows), None)
    want = [(1, a), (2, b), (3, c), (None, d), (4, ""), (4, "")]
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr) == sorted(want, key=repr)
    assert kept.columns == ["doc_id", "text", "score"]


def test_merge_and_probe():
    batch = pa.RecordBatch.from_arrays([pa.array([9]), pa.array([[[1, 2], [2, 3], [2]]]), pa.array([2])], names=["a", "lists", "least"])
    merged, = ngram_join._merge(batch)
    assert merged.to_pylist() == [{"a": 9, "b": 2, "times": 3}]
    pairs = pa.RecordBatch.from_arrays([pa.array(x) for x in ([1, 1], [2, 3], [1, 1], [3, 3], [[4, 7, 9], [4]], [[1, 7, 9], [5]])], names=list("abcdef"))
    assert next(ngram_join._probe(pairs)).to_pylist() == [{"a": 1, "b": 2}]


def test_pieces(spark):
    known = pieces.Vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    for value in ("", " ", "a  b", "\n\n x", "🙂é\tq", "x" * 300, prose(3, 200)):
        ids = known.encode(value)
        assert known.decode(ids).decode() == value
        mark = "▁" + value.replace(" ", "▁") if value else ""
        assert list(known.stream(mark)) == ids

    def score(chars):  # brute force over all segmentations
        best = [0.0] + [-1e300] * len(chars)
        for end in range(1, len(chars) + 1):
            for start in range(end):
                hit = known.pieces.get(chars[start:end])
                if hit or end == start + 1:
                    best[end] = max(best[end], best[start] + (hit[1] if hit else known.unknown))
        return best[-1]
    for word in prose(4, 50).split():
        ids = known.short("▁" + word)
        assert sum(known.pieces[p][1] for p in map(lambda k: known.bytes_of[k].decode().replace(" ", "▁"), ids)) == score("▁" + word)
    out = {r["doc_id"]: r for r in pieces.encode(docs(spark, ODD + [(1, "▁x")]), public_tokenizers.path("piece_bpe_32k.model")).collect()}
    assert out[900]["n_tokens"] == 0 and out[903]["exact"] and not out[1]["exact"]


def test_long_lists_between_light_and_heavy_nodes(spark, monkeypatch):
    """Candidates are the pairs of nodes of compatible sizes that share enough lists, however long these are."""
    monkeypatch.setattr(ngram_join, "LONG_LIST", 2)
    rng = random.Random(5)
    held = {node: (rng.randint(50, 210), set(rng.sample(range(8), rng.randint(0, 5))) | set(rng.sample(range(100, 140), rng.randint(1, 6))))
            for node in range(60)}
    held |= {60: (60, {200, 1}), 61: (66, {200, 1, 2, 3, 4}), 62: (66, {201, 1, 2, 3, 4}), 63: (60, {201, 1})}
    lists = [(name, node, n) for node, (n, names) in held.items() for name in names]
    size = {name: sum(row[0] == name for row in lists) for name, _, _ in lists}
    shared = spark.createDataFrame([row for row in lists if size[row[0]] > 1], "list long, node long, n long")
    repeated = spark.createDataFrame([row for row in size.items() if row[1] > 1], "list long, size long")
    want = {(a, b) for a, (n, x) in held.items() for b, (m, y) in held.items()
            if b < a and min(n, m) * 100 >= max(n, m) * 90 and len(x & y) >= 1 + min(n, m) // 50}
    out = [(r["a"], r["b"]) for r in ngram_join._rest(ngram_join._mixed(shared, None), repeated, 90).collect()]
    assert {(61, 60), (63, 62)} <= want == set(out) and len(out) == len(want)


@pytest.mark.parametrize("values", [np.random.default_rng(k).integers(0, 30 if k % 2 else 1 << 40, 150).astype(np.uint64) for k in range(6)])
def test_compact_windows(values):
    want = set()
    for c in range(len(values)):
        left = right = c
        while left and values[left - 1] > values[c]:
            left -= 1
        while right < len(values) - 1 and values[right + 1] >= values[c]:
            right += 1
        if right - left + 1 >= 12:
            want.add((left, c, right))
    assert set(passages.compact_windows(values, 12)) == want


def test_passages(spark):
    shared, near = prose(50, 60), prose(51, 100).split()
    rows = [(1, f"{prose(1, 30)} {shared} {prose(2, 30)}"), (2, f"{prose(3, 80)} {shared}"), (3, prose(4, 100)),
            (4, " ".join(near)), (5, " ".join(near[:50] + ["other"] + near[51:])), (6, prose(7, 70)), (7, prose(7, 70)), (8, prose(7, 49))]
    out = passages.report(docs(spark, rows + ODD)).collect()
    assert {r["doc_id"] for r in out} >= {1, 2, 4, 5, 6, 7} and not {3, 8} & {r["doc_id"] for r in out}
    assert (1, 2, 30, 90) in {(r["doc_id"], r["partner_id"], r["first_word"], r["end_word"]) for r in out}
    assert passages.report(docs(spark, [])).count() == 0


def test_passages_behind_a_common_line(spark):
    """Every pair has a passage of its own that begins with a line that all texts hold."""
    line = prose(60, 40)
    rows = [(2 * k + half, f"{prose(100 + 2 * k + half, 60)} {line} {prose(200 + k, 15)} {prose(300 + 2 * k + half, 60)}")
            for k in range(12) for half in (0, 1)]
    out = passages.report(docs(spark, rows)).collect()
    assert {(r["doc_id"], r["first_word"]) for r in out if r["end_word"] >= 115} >= {(doc_id, 60) for doc_id, _ in rows}


def test_passages_of_texts_that_a_leader_covers(spark):
    """L, X and Y share a line; X shares words before it with L, and words behind it with Y, which has nothing else of L."""
    rows = []
    for k in range(12):
        line, before, behind = prose(1000 + k, 45), prose(1100 + k, 20), prose(1200 + k, 20)
        own = [prose(1300 + 10 * k + j, 60) for j in range(6)]
        rows += [(3 * k, f"{before} {line} {own[0]}"), (3 * k + 1, f"{own[1]} {before} {line} {behind} {own[2]}"),
                 (3 * k + 2, f"{own[3]} {line} {behind} {own[4]} {own[5]}")]
    out = {(r["doc_id"], r["first_word"], r["end_word"]) for r in passages.report(docs(spark, rows)).collect()}
    assert out >= {(3 * k + 2, 60, 125) for k in range(12)}, sorted(out)


def contest(k):
    """Two texts with a near passage of 60 words, at 2 * k and 2 * k + 1, among short texts that hold one phrase of it each."""
    shared = prose(5000 + k, 60).split()
    near = shared[:30] + ["zzz"] + shared[31:]
    mine, other = (f"{prose(6000 + 4 * k + j, 50)} {' '.join(words)} {prose(6002 + 4 * k + j, 50)}" for j, words in enumerate((shared, near)))
    rows, words = [(2 * k, mine), (2 * k + 1, other)], mine.split()
    for n, window in enumerate(next(passages._windows(pa.record_batch({"node": pa.array([0]), "text": [mine]}))).to_pylist()):
        if 50 <= window["c"] < 106:
            phrase = " ".join(words[window["c"]:window["c"] + 5])
            rows += [(10_000 + 1_000 * k + 20 * n + j, f"{prose(f'{k} {n} {j}', 26)} {phrase} {prose(f'{k} {n} {j} behind', 26)}") for j in range(20)]
    return rows


CONTESTS = (34, 35, 39)


def test_near_passages_behind_more_leaders_than_turns(spark):
    rows = [row for k in CONTESTS for row in contest(k)]
    out = {(r["doc_id"], r["partner_id"], r["first_word"], r["end_word"]) for r in passages.report(docs(spark, rows)).collect()}
    assert out >= {pair for k in CONTESTS for pair in ((2 * k, 2 * k + 1, 50, 110), (2 * k + 1, 2 * k, 50, 110))}


def test_texts_without_a_common_run_are_not_aligned(spark, monkeypatch):
    """Phrases of nine words in many texts hold no passage; of three near copies, two are not compared again when one has led."""
    counted, compare = [], passages._compared
    monkeypatch.setattr(passages, "_compared", lambda anchors, *rest: counted.append(
        anchors.select("node", "other").distinct().count()) or compare(anchors, *rest))
    rows = [(10 * k + j, f"{prose(7000 + 10 * k + j, 60)} {prose(7900 + k, 9)} {prose(8000 + 10 * k + j, 60)}") for k in range(6) for j in range(8)]
    assert passages.report(docs(spark, rows)).count() == 0 and sum(counted) == 0
    counted.clear()
    near = prose(52, 120).split()
    copies = [" ".join(near), *(" ".join(near[:at] + ["other"] + near[at + 1:]) for at in (40, 80))]
    out = {(r["doc_id"], r["first_word"], r["end_word"]) for r in passages.report(docs(spark, rows + [(900 + k, copy) for k, copy in enumerate(copies)])).collect()}
    assert {(900, 0, 120), (901, 0, 120), (902, 0, 120)} <= out and {doc_id for doc_id, _, _ in out} == {900, 901, 902} and sum(counted) <= 6


@pytest.mark.parametrize("words", [["word"], ["one", "two"], prose(53, 30).split()])
def test_repetitive_texts(spark, words):
    """A text that repeats a few words has a window for some of its places only, and passages over its repeats."""
    own = [prose(8200 + k, 60) for k in range(2)]
    rows = [(k, f"{own[k]} {' '.join((words * 300)[:250 + 100 * k])}") for k in range(2)]
    batch = pa.record_batch({"node": pa.array([0, 1]), "text": pa.array([row[1] for row in rows])})
    assert next(passages._windows(batch)).num_rows < 400
    held = {k: set() for k in range(2)}
    for r in passages.report(docs(spark, rows)).collect():
        held[r["doc_id"]] |= set(range(r["first_word"], r["end_word"]))
    assert all(held[k] >= set(range(60, 310 + 50 * k)) and not held[k] & set(range(55)) for k in range(2))


def near_pair(seed, n, change):
    """Two texts that share n random words, one of which is changed, in random surroundings."""
    rng = random.Random(seed)
    fresh = iter(rng.sample(range(10**6), n + 201)).__next__
    shared = [f"w{fresh()}" for _ in range(n)]
    at = rng.randrange(n // 2 - 3, n // 2 + 3)
    other = shared[:at] + ([] if change == "delete" else [f"w{fresh()}"]) + shared[at + (change != "insert"):]
    around = [[f"w{fresh()}" for _ in range(50)] for _ in range(4)]
    return shared, other, [" ".join(around[k] + words + around[2 + k]) for k, words in enumerate((shared, other))]


@pytest.mark.parametrize("change", ["replace", "insert", "delete"])
@pytest.mark.parametrize("n", [51, 60, 80, 100])
def test_recall_of_near_passages(change, n):
    """Windows with one signature and their alignment, against the similarity of the planted passages."""
    found = similar = 0
    for seed in range(150):
        shared, other, texts = near_pair(seed, n, change)
        x, y = ({tuple(words[k:k + 5]) for k in range(len(words) - 4)} for words in (shared, other))
        if len(x & y) < 0.8 * len(x | y) or min(len(shared), len(other)) < passages.MIN_WORDS:
            continue
        similar += 1
        batch = pa.RecordBatch.from_arrays([pa.array([0, 1]), pa.array(texts)], names=["node", "text"])
        windows = next(passages._windows(batch)).to_pylist()
        tokens = dict(passages._tokens(batch.column(1)))
        anchors = [(a["c"], a["l"], a["r"], b["c"], b["l"], b["r"]) for a in windows if a["node"] == 0
                   for b in windows if b["node"] == 1 and a["sig"] == b["sig"]]
        spans = passages._passages(tokens[0], tokens[1], anchors)
        found += any((s, e + 4, t, u + 4) == (50, 50 + len(shared), 50, 50 + len(other)) for s, e, t, u in spans)
    assert similar >= 100 and found >= 0.95 * similar, (found, similar)


def test_embeddings(spark):
    rng = np.random.default_rng(3)
    rows = []
    for k in range(300):
        center = np.random.default_rng(k % 40).standard_normal(16)
        rows.append((k, (center + 0.03 * rng.standard_normal(16)).tolist(), k % 40 % 3))
    rows += [(400, rows[0][1], rows[0][2]), (401, rows[0][1], None), (402, None, 1), (403, [0.0] * 16, 1), (404, [float("nan")] * 16, 1),
             (405, [1.0, None], 1), (406, [1.0, 2.0], 1)]
    out = {r["vec_id"]: r for r in embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()}
    usable = rows[:301]
    x = np.array([np.float32(r[1]) for r in usable], dtype=np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    close = (x @ x.T >= 0.98) & (np.array([r[2] for r in usable])[:, None] == np.array([r[2] for r in usable]))
    np.fill_diagonal(close, False)
    got = np.array([out[r[0]]["n_links"] for r in usable])
    assert (got <= close.sum(1)).all() and got.sum() >= 0.9 * close.sum()
    for k in (401, 402, 403, 404, 405, 406):
        assert (out[k]["n_links"], out[k]["component_id"], out[k]["kept"]) == (0, k, True)
    assert embeddings.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def test_recall_in_a_large_spread_out_label(spark):
    """Each of 400 vectors has one partner at 0.981 among 20,000 random vectors of one label."""
    rng = np.random.default_rng(17)
    x = rng.standard_normal((20_000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    aside = rng.standard_normal((400, 64))
    aside -= (aside * x[:400]).sum(1)[:, None] * x[:400]
    aside /= np.linalg.norm(aside, axis=1, keepdims=True)
    x = np.concatenate([x, 0.981 * x[:400] + np.sqrt(1 - 0.981 ** 2) * aside])
    rows = spark.createDataFrame([(k, row, 1) for k, row in enumerate(x.tolist())], "vec_id long, embedding array<double>, label int")
    out = {r["vec_id"]: r["n_links"] for r in embeddings.near_duplicates(rows).collect()}
    assert sum(out[k] for k in range(400)) >= 0.95 * 400, sum(out[k] for k in range(400))


def test_decontaminate(spark):
    item = prose(77, 25)
    rows = [(1, f"start {item.upper().replace('É', 'é')} end"), (2, " ".join(item.split()[3:14])), (3, prose(5, 50)), (4, "a short one!"), (5, " ".join(item.split()[:9]))]
    bench = spark.createDataFrame([(10, item), (11, "Short one"), (12, None), (None, "x"), (13, "?!")], "item_id long, text string")
    out = {r["doc_id"]: r for r in decontaminate.report(docs(spark, rows + ODD), bench).collect()}
    assert [(out[k]["n_hit"], out[k]["n_items"]) for k in (1, 2, 3, 4, 5, 900)] == [(25, 1), (11, 1), (0, 0), (2, 1), (0, 0), (0, 0)]
    assert out[1]["items_sha256"] == hashlib.sha256(b"10").hexdigest()
    cut = {r["doc_id"]: r["text"] for r in decontaminate.remove(docs(spark, rows + ODD), bench).collect()}
    assert cut[1] == "start  end" and cut[900] is None and cut[3] == rows[2][1]
    assert decontaminate.report(docs(spark, rows), bench.limit(0)).filter("contaminated").count() == 0
    blocks = decontaminate.BLOCK_CHARS
    try:
        decontaminate.BLOCK_CHARS = 8  # a pass per item or so
        again = {r["doc_id"]: r for r in decontaminate.report(docs(spark, rows + ODD), bench).collect()}
    finally:
        decontaminate.BLOCK_CHARS = blocks
    assert again == out


@pytest.mark.parametrize("top", [3, 50, 5000])
def test_index_finds_every_place(top):
    """Also where the benchmark has more words than the shard has places."""
    for seed in range(6):
        rng = np.random.default_rng(seed)
        sequence = rng.integers(1, top + 1, int(rng.integers(3, 120)))
        sequence[rng.random(len(sequence)) < 0.15] = 0
        sequence = np.concatenate([[0], sequence, [0]])
        index = decontaminate.Index(sequence, top)
        for length in (1, 2, 3, 4):
            for at in range(len(sequence) - length):
                pattern = sequence[at:at + length]
                if (pattern > 0).all():
                    low, high = index.search(pattern[None].astype(np.int32), np.array([length]))
                    want = [k for k in range(len(sequence) - length + 1) if np.array_equal(sequence[k:k + length], pattern)]
                    assert sorted(index.locate(np.arange(low[0], high[0])).tolist()) == want


def test_licenses(spark):
    rows = [(1, "Released under CC-BY cc by; All rights  reserved"), (2, "general public licenses"),
            (3, "SPDX-License-Identifier: (MIT OR GPL-2.0-only WITH Classpath-exception-2.0) AND Apache-2.0\nnext")]
    out = {r["doc_id"]: r for r in licenses.scan(docs(spark, rows + ODD)).collect()}
    assert (out[1]["n_words"], out[1]["n_base"], out[1]["first_word"], out[1]["last_word"], out[1]["base_labels"]) == (9, 3, 2, 6, "cc-by,reserved")
    assert out[2]["n_base"] == 0 and out[2]["first_word"] is None and out[901]["score"] == 0
    assert out[3]["labels"] == "apache,apache-2.0,gpl-2.0,mit,spdx-tag"
    assert licenses.evaluate("MIT OR GPL-3.0 AND AGPL-3.0")[1] == 1 and licenses.evaluate("(MIT OR GPL-3.0) AND AGPL-3.0")[1] == 2
    with pytest.raises(licenses.BadExpression):
        licenses.postfix("MIT AND (GPL-3.0")


def test_coder():
    rng = np.random.default_rng(0)
    blocks = [rng.integers(0, 1 << 16, n) for n in (1, 2, 5, 700)] + [np.full(3000, 7), np.tile(np.arange(50), 40), np.minimum(rng.zipf(1.3, 3000), 65535)]
    payloads = coder.encode(blocks)
    assert all(np.array_equal(a, b) for a, b in zip(blocks, coder.decode(payloads, [len(b) for b in blocks]), strict=True))
    assert len(payloads[4]) < 60 and coder.encode([]) == []


def test_token_files(spark):
    from tokenizers import Tokenizer
    path = public_tokenizers.path("word_bpe_49k.json")
    rows = [(k, prose(k, 50) + " It's <|endoftext|> 12,5 é x y\x1cz") for k in range(20)] + [(900, None), (901, "")]
    out = sorted(token_files.report(docs(spark, rows), path).collect())
    known, place = Tokenizer.from_file(path), 0
    for row, (doc_id, value) in zip(out, rows, strict=True):
        ids = np.array([*known.encode(value or "", add_special_tokens=False).ids, 2], dtype="<u4")
        assert tuple(row) == (doc_id, place, len(ids), zlib.crc32(ids.tobytes()))
        place += len(ids)
    assert token_files.report(docs(spark, []), path).count() == 0


def test_chat(spark):
    say = "conv_id long, turn long, role string, text string"
    rows = [(1, 0, "user", "hi"), (2, 0, "user", "hi"), (2, 1, "bot", "yo"), (3, 0, "user", "hi"), (3, 1, "bot", "yo"), (3, 2, "user", None),
            (4, 5, "user", "hi"), (4, 6, "bot", "no"), (5, 0, "user", ""), (6, 0, "user", None), (None, 0, "user", "lost"), (7, 0, "user", "hi"), (7, 1, "bot", "no")]
    out = {r["conv_id"]: r for r in chat.collapse_and_render(spark.createDataFrame(rows, say)).collect()}
    assert sorted(out) == [3, 4, 5, 6] and out[4]["n_copies"] == 2
    assert out[3]["rendered"] == "<|user|>\nhi\n<|bot|>\nyo\n<|user|>\n\n<|end|>"
    assert chat.collapse_and_render(spark.createDataFrame([], say)).count() == 0


def test_batches_are_cut_by_bytes(spark):
    """3,000 texts of 8,000 characters came as one batch of 24 MB."""
    from haulmark.llm.common import map_batches, record_batch

    def size(batch):
        yield record_batch(rows=[batch.num_rows], held=[batch.nbytes])
    texts = spark.range(0, 3_000, 1, 1).select(F.repeat(F.lit("abcdefgh"), 1_000).alias("text"))
    sizes = map_batches(texts, "rows long, held long", size).collect()
    assert sum(r["rows"] for r in sizes) == 3_000 and max(r["held"] for r in sizes) < 5 << 20
