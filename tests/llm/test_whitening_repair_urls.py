"""Whitening, conversation repair and URL filter against brute force, with nulls, repeats, long input and empty tables."""

import hashlib
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from haulmark.llm import chat_repair, queries, url_filter, whitening
from haulmark.llm.oracles import ORACLES
from tests.conftest import SF_DIR

# --- whitening ------------------------------------------------------------------------------------------------------


def test_scatter_is_exact():
    rng = np.random.default_rng(1)
    wide = rng.integers(-2**62, 2**62, (100, 4))
    wide[0], wide[1] = 2**63 - 1, -2**63
    for x in (rng.integers(-50, 50, (130, 7)) + 10**6, wide, np.full((65, 3), 9), rng.integers(0, 2, (1, 5))):
        sums, products = whitening.scatter(x)
        whole = x.astype(object)
        assert (sums == whole.sum(axis=0)).all() and (products == whole.T @ whole).all()


def brute_whitening(vectors):
    """x of the given vectors, and n, S, eigenvalues and scaled axes over the distinct ones, in plain NumPy."""
    x = np.floor(np.asarray(vectors, float) * 64).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    centred = fit - fit.mean(axis=0)
    values, axes = np.linalg.eigh(centred.T @ centred / len(fit))
    return x, fit, values[::-1], axes[:, ::-1]


def check_whitening(rows, out):
    x, fit, values, axes = brute_whitening([v for _, v in rows])
    n, sums = len(fit), fit.sum(axis=0)
    by_row = {}
    for r in out:
        by_row.setdefault(r["vec_id"], {})[r["component"]] = r
    k = min(16, len(values))
    for (key, _), point in zip(rows, x):
        found = by_row[key]
        assert sorted(found) == list(range(1, k + 1))
        whole = point.astype(object) * n - sums.astype(object)
        assert {r["deviation"] for r in found.values()} == {int((whole * whole).sum())}
        assert {r["n"] for r in found.values()} == {n}
        want = (point - sums / n) @ axes[:, :k] / np.sqrt(values[:k])
        got = np.array([found[c]["whitened"] for c in range(1, k + 1)])
        assert np.allclose(np.abs(got), np.abs(want), atol=1e-6)
        assert np.allclose([found[c]["explained"] for c in range(1, k + 1)], values[:k] / values.sum(), rtol=1e-9)
        assert all(r["identity_error"] < 1e-9 for r in found.values())


def test_whitening_of_the_table(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()]
    check_whitening(rows, queries.op11_embedding_whitening(spark, SF_DIR).collect())


def test_whitening_of_odd_rows(spark):
    rng = np.random.default_rng(2)
    good = [(k, [float(v) for v in rng.normal(size=5) * [1, 3, 0.5, 40, 2]]) for k in range(300)]
    good += [(k + 1000, v) for k, v in good[:150]] + [(5000 + k, good[0][1]) for k in range(200)]  # copies
    odd = [(9001, None), (9002, [1.0, None, 1.0, 1.0, 1.0]), (9003, [float("nan")] * 5), (9004, [1.0, float("inf"), 0.0, 0.0, 0.0]),
           (9005, []), (9006, [1.0, 2.0]), (9007, [1.0] * 6)]
    schema = "vec_id long, embedding array<double>, n string, whitened string"
    frame = spark.createDataFrame([(*r, "a", "b") for r in good + odd], schema)
    out = whitening.whiten(frame).collect()
    check_whitening(good, out)
    assert not {r["vec_id"] for r in out} & {k for k, _ in odd}
    signs = {}
    for r in out:  # copies have one result, so the sign is the same for all rows
        signs.setdefault((r["vec_id"] % 1000 if r["vec_id"] < 2000 else 0, r["component"]), set()).add(r["whitened"])
    assert all(len(v) == 1 for v in signs.values())
    assert whitening.whiten(frame.limit(0)).count() == 0
    assert whitening.whiten(frame.filter("vec_id >= 5000 and vec_id < 9000")).count() == 0  # one distinct vector
    assert whitening.whiten(frame.filter("vec_id is null")).columns == whitening.whiten(frame).columns


def test_whitening_of_flat_and_huge_dimensions(spark):
    rows = [(k, [float(k), 2.0 * k, 1e300 if k % 2 else 0.0]) for k in range(20)]
    out = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert len(out) == 20 and all(r["deviation"] is None for r in out)  # one component; squares beyond a long
    rows = [(k, [float(k), 2.0 * k, 0.0]) for k in range(20)]
    out = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {r["component"] for r in out} == {1} and np.isclose(np.var([r["whitened"] for r in out]), 1)


def test_whitened_space_is_white_over_many_batches(spark):
    keep = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "70")
    try:
        rng = np.random.default_rng(3)
        rows = [(k, [float(v) for v in rng.normal(size=20) * np.arange(1, 21)]) for k in range(900)]
        check_whitening(rows, whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect())
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", keep)


# --- conversations --------------------------------------------------------------------------------------------------


def cheapest(symbols, start=0):
    """Least (cost, audit) by relaxation over rows and states, at most four inserts between two rows."""
    best = {start: (0, "")}

    def insert(best):
        for _ in range(4):
            for s, (cost, audit) in list(best.items()):
                t = {0: 2, 1: 2, 2: 3, 3: 2}[s]
                best[t] = min(best.get(t, (10**9, "")), (cost + 2, audit + "I"))
        return best

    best = insert(best)
    for symbol in symbols:
        after = {}
        for s, (cost, audit) in best.items():
            ways = [(s, 3, "D")]
            if symbol not in "BD":
                cut = symbol.isupper()
                ways += [(t, cut, "K") for (a, c), t in (((0, "s"), 1), ((0, "u"), 2), ((1, "u"), 2), ((2, "a"), 3), ((3, "u"), 2))
                         if a == s and c == symbol.lower()]
                ways += [({0: 2, 1: 2, 2: 3, 3: 2}[s], 2 + cut, "R")]
            for t, more, letter in ways:
                after[t] = min(after.get(t, (10**9, "")), (cost + more, audit + letter))
        best = insert(after)
    return best


def test_agenda():
    rng = random.Random(4)
    for _ in range(1500):
        symbols = "".join(rng.choice("uauausoUASODB") for _ in range(rng.randint(0, 12)))
        start = rng.randrange(4)
        assert chat_repair.lightest(symbols, start) == cheapest(symbols, start)


def brute_repair(rows, original):
    """The report, row by row, from (conv_id, turn, role, text) rows after damage."""
    talks = {c: [] for c in original}
    for conv, turn, role, text in rows:
        talks.setdefault(conv, []).append((turn, role if role is not None else " ", text if text is not None else " "))
    out = {}
    for conv, talk in talks.items():
        talk.sort(key=lambda r: (r[0] is not None, r[0], r[1], r[2]) if r[0] is not None else (False, 0, r[1], r[2]))
        seen, symbols, counts = set(), "", Counter()
        for _, role, text in talk:
            initial = role[:1] if role[:1] in ("s", "u", "a") else "o"
            bare = text.rstrip(" \t\n\x0b\f\r")
            if not bare:
                symbols, counts["blank"] = symbols + "B", counts["blank"] + 1
            elif (role, text) in seen:
                symbols, counts["duplicate"] = symbols + "D", counts["duplicate"] + 1
            elif bare[-1] not in ".!?":
                symbols, counts["truncated"] = symbols + initial.upper(), counts["truncated"] + 1
            else:
                symbols += initial
            seen.add((role, text))
        turns = [t for t, _, _ in talk if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(talk, talk[1:]))
        best = cheapest(symbols)
        cost, audit = min(best[s] for s in (0, 3) if s in best)
        lines, at, state = [], 0, 0
        for edit in audit:
            role, text = ("", "") if edit == "I" else talk[at][1:]
            at += edit != "I"
            if edit == "D":
                continue
            if edit != "K":
                role = "assistant" if state == 2 else "user"
            lines.append(f"{role}:{text}")
            state = {"s": 1, "u": 2, "a": 3}[role[0]]
        out[conv] = (gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


FIELDS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def brute_damage(rows):
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        for _ in range(1 + (fault == 3)):
            yield conv, turn, "user" if fault == 4 else role, text


def test_repair_of_the_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = brute_repair(list(brute_damage(rows)), {r[0] for r in rows})
    got = {r["conv_id"]: tuple(r[f] for f in FIELDS) for r in queries.op12_chat_repair(spark, SF_DIR).collect()}
    assert got == want and any("I" in v[6] for v in want.values()) and any("R" in v[6] for v in want.values())


TALK = "conv_id long, turn long, role string, text string"


def odd_talks():
    rng = random.Random(6)
    rows = [(1, 0, "user", "Hi."), (1, 5, "assistant", "Ho!"), (1, None, "system", "Be kind."), (2, 0, None, None), (3, 1, "", "x."),
            (3, 1, "", "x."), (4, None, "user", "a?"), (4, None, "user", "b?"), (None, 0, "user", "nobody. "), (None, 1, "tool", "who"),
            (5, 0, "user", "é" * 200_000), (6, 0, "user", " \x0b\n"), (7, -2**63, "user", "low."), (7, 2**63 - 1, "assistant", "high.")]
    rows += [(8, 3, "user", "same.")] * 40
    for _ in range(400):
        text = rng.choice(["Yes.", "No", "", None, "Well? ", "ok!", "1.", "2"])
        rows.append((100 + rng.randrange(40), rng.choice([None, *range(9)]), rng.choice(["system", "user", "user", "assistant", "tool", None, ""]), text))
    return rows


def test_repair_of_odd_rows(spark):
    rows = odd_talks()
    frame = spark.createDataFrame([(*r, "kept") for r in rows], TALK + ", cost string")
    want = brute_repair(rows, [])
    got = {r["conv_id"]: tuple(r[f] for f in FIELDS) for r in chat_repair.report(frame).collect()}
    assert want[7][0] == 2**64 - 2 and got[7][0] is None  # a gap beyond a long
    del want[7], got[7]
    assert got == want
    damaged = brute_repair(list(brute_damage(rows)), {r[0] for r in rows})
    got = {r["conv_id"]: tuple(r[f] for f in FIELDS) for r in chat_repair.report(chat_repair.damage(frame), frame.select("conv_id")).collect()}
    assert {k: v for k, v in got.items() if k != 7} == {k: v for k, v in damaged.items() if k != 7}
    empty = frame.limit(0)
    assert chat_repair.report(chat_repair.damage(empty), empty.select("conv_id")).count() == 0


def test_all_rows_dropped(spark):
    dropped = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    frame = spark.createDataFrame([(dropped, 0, "user", "Gone.")], TALK)
    row, = chat_repair.report(chat_repair.damage(frame), frame.select("conv_id")).collect()
    assert tuple(row) == (dropped, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())


def test_one_hot_conversation_in_pieces(spark, monkeypatch):
    """A conversation of many pieces over many tasks equals the whole, and its repaired rows alternate."""
    monkeypatch.setattr(chat_repair, "_CHUNK_BITS", 3)
    rng = random.Random(8)
    rows = [(1, t, rng.choice(["user", "assistant"]), rng.choice(["Yes.", "No", "", f"{t}.", f"{t}"])) for t in range(900)]
    rows += [(k, t, "user" if t % 2 == 0 else "assistant", f"{t}.") for k in (2, 3, None) for t in range(30)]
    rows += [(4, None, "user", "again.")] * 200
    frame = spark.createDataFrame(rows, TALK).repartition(7)
    want = brute_repair(rows, [])
    got = {r["conv_id"]: tuple(r[f] for f in FIELDS) for r in chat_repair.report(frame).collect()}
    assert got == want
    turns = chat_repair.ordered(frame)
    plans = chat_repair.plan(turns)
    said = chat_repair.repaired(turns, plans).orderBy("conv_id", "chunk", "place").collect()
    for conv in (1, 2, 4):
        assert re.fullmatch("(s?(ua)+)?", "".join(r["role"][0] for r in said if r["conv_id"] == conv))
    text = "\n".join(f"{r['role']}:{r['text']}" for r in said if r["conv_id"] == 1)
    assert hashlib.sha256(text.encode()).hexdigest() == want[1][7]


# --- URLs -----------------------------------------------------------------------------------------------------------


def as_regex(glob):
    out, at = "", 0
    while at < len(glob):
        if glob.startswith("**", at):
            out, at = out + ".*", at + 2
            continue
        c = glob[at]
        if c == "\\" and at + 1 < len(glob):
            at += 1
            out += re.escape(glob[at])
        else:
            out += {"*": "[^/]*", "?": "[^/]"}.get(c, re.escape(c))
        at += 1
    return re.compile(out + r"\Z", re.DOTALL)


def test_automaton(monkeypatch):
    rng = random.Random(9)
    globs = ["".join(rng.choice("ab/é*?é*\\") for _ in range(rng.randint(0, 9))) for _ in range(150)]
    texts = ["".join(rng.choice("ab/é*") for _ in range(rng.randint(0, 12))) for _ in range(700)] + ["a" * 5000, "é/" * 3000 + "b", ""]
    want = {(i, j) for j, glob in enumerate(globs) for fits in [as_regex(glob)] for i, text in enumerate(texts) if fits.match(text)}
    automaton = url_filter.Automaton(globs)
    assert automaton.words > 5
    plain = pa.array(texts).cast(pa.large_binary())
    _, offsets, data = plain.buffers()
    for lockstep, states in ((2048, 16 << 20), (4, 1)):
        monkeypatch.setattr(url_filter, "LOCKSTEP_BYTES", lockstep)
        monkeypatch.setattr(url_filter, "_STATE_BYTES", states)
        rows, found = automaton.matches(np.frombuffer(data, np.uint8), np.frombuffer(offsets, np.int64)[:len(texts) + 1])
        assert len(rows) == len(want) and set(zip(rows.tolist(), found.tolist())) == want


def test_too_many_globs(monkeypatch):
    monkeypatch.setattr(url_filter, "MAX_MASK_BYTES", 1 << 12)
    with pytest.raises(ValueError):
        url_filter.Automaton(["a" * 100])


URLS = [None, "", "no scheme", "http://", "http://Example.ORG", "http://example.org/", "https://www.EXAMPLE.org/es/1?q=://x", "x://example.org/en/1",
        "x://example.org/en/19#f", "x://example.org/en/21", "x://badexample.org/es/", "http://a.com/fr/", "http://com/fr/x", "http://a.com/de/",
        "http://evil.net/a.com/de/", "http://evil.net/x.org/", "http://a.com?b=/fr/", "http://spam-x.net/about.html", "http://spam-x.net/y",
        "http://www.spam.net/y", "http://a.net/x.pdf", "http://a.net/x.pdf?y", "http://a.net/X.PDF", "http://a.pdf", "http://a.net/login/z",
        "http://a.net/de/login/z", "http://a.net/a/b/login/z", "http://a.net/q/wp-admin/", "http://É.Org/ä", "a://b://org/x", "http://.org/",
        "http://u@ads.net/", "http://ads.net/", "http://a.net/" + "x/" * 100_000 + "wp-admin/", "http://a.net/x\ny.zip"]


def test_urls_equal_their_sql(spark):
    rows = [(k, u, "kept", "kept") for k, u in enumerate(URLS)] + [(None, URLS[6], "", ""), (3, URLS[6], "", ""), (3, URLS[6], "", "")]
    frame = spark.createDataFrame(rows, "page_id long, url string, host string, verdict string")
    got = Counter(tuple(r) for r in url_filter.judge(frame).drop("pattern").collect())
    con = duckdb.connect()
    pages = pa.table({"page_id": pa.array([r[0] for r in rows], pa.int64()), "url": [r[1] for r in rows]})
    con.register("pages", pages)
    assert got == Counter(con.execute(ORACLES["op13_url_filter"]).fetchall())
    assert url_filter.judge(frame.limit(0)).count() == 0


def test_verdicts_of_own_rules(spark):
    frame = spark.createDataFrame([(k, u) for k, u in enumerate(URLS)], "page_id long, url string")
    out = {r["page_id"]: r for r in url_filter.judge(frame, site=[("net", "/x", "block")], globs=[("*.net/**", "block"), ("a.*/*", "allow")]).collect()}
    assert out[20]["verdict"] == "block" and out[20]["rule"] == "net/x"
    assert out[24]["verdict"] == "block" and out[24]["pattern"] == "*.net/**"
    assert out[0]["verdict"] == "allow" and out[0]["pattern"] is None
