"""Secret scan in DataFrame functions: three base patterns and high-entropy strings.

Places come from a pattern's matches and the pieces between them: a match starts where all earlier pieces and
matches end, counted in characters. High entropy: a candidate is a maximal run of at least ``WINDOW`` key
characters with a digit and a letter in it. Per character class a window of ``WINDOW`` characters slides over it;
symbol counts and the sum of c * log2(c) are updated by the one character that enters and the one that leaves,
and a character outside the class starts the window anew. Windows at or above the class's threshold give one
span, from the first such window to the last. The allow-list suppresses candidates; spans inside a base span are
not repeated.

Each document is worked on in its own row, so nothing is shuffled and no key can be hot.

Defined cases: null and empty texts have no spans, counts of 0 and the hash of the empty string. Equal starts
are ordered by kind, as listed in ``KINDS``. Repeated rows give equal rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulmark.llm.common import cut, once, packed, running, unpacked

# The base patterns.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]+"
KINDS = ("assign", "access", "hex", "entropy_hex", "entropy_mixed")
_BASE = 3  # so many of them are base kinds

WINDOW = 20
#: Characters of each class and the least entropy, in bits, of a window that counts.
CLASSES = {"entropy_hex": ("0123456789abcdef", 2.9),
           "entropy_mixed": ("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-", 3.7)}
CANDIDATE = "[A-Za-z0-9+/_=-]{20,}"
ALLOWED = r"(?i)example|sample|dummy|placeholder|your[_-]?key|changeme|xxxx|(.)\1{7}"
MASK = "[SECRET]"
#: Counts reach ``WINDOW``; sums of c * log2(c) are whole numbers of 2^-32, so that they do not drift along a text.
_BITS = 5
_PER_WORD = 12

_SPAN = "array<struct<start:int,kind:int,end:int>>"


def _scaled(value: float) -> int:
    return round(value * 2**32)


def _places(text: Column, pattern: str, matches: Column) -> Column:
    """(start, end) of each match, from the lengths of the pieces between matches and of the matches."""
    steps = F.zip_with(F.transform(F.split(text, pattern, -1), F.length), F.transform(matches, F.length),
                       lambda gap, size: F.struct(gap.alias("gap"), size.alias("size")))
    zero = F.struct(F.lit(0).alias("start"), F.lit(0).alias("end"))
    # The last piece has no match behind it.
    return running(F.filter(steps, lambda x: x["size"].isNotNull()), zero, lambda at, x: F.struct(
        (at["end"] + x["gap"]).alias("start"), (at["end"] + x["gap"] + x["size"]).alias("end")))


def _base(text: Column, kind: str, pattern: str, has: str, least: int, group: int = 0) -> Column:
    """Spans of one base kind; ``has`` tells cheaply whether a text can have any."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    judged = matches if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    both = F.arrays_zip(_places(text, pattern, matches).alias("at"), F.transform(judged, F.length).alias("size"))
    found = F.transform(F.filter(both, lambda x: x["size"] >= least), lambda x: F.struct(
        x["at"]["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), x["at"]["end"].alias("end")))
    return F.when(text.rlike(has), found).otherwise(F.expr(f"CAST(array() AS {_SPAN})"))


def _entropy_range(candidate: Column, symbols: str, least: float) -> Column:
    """(first, end) of the windows with enough entropy, relative to the candidate; nulls if there is none.

    The counts of the symbols in the window are packed, ``_PER_WORD`` in a word of 64 bits; a character that enters and one
    that leaves change at most two of these words.
    """
    words = -(-len(symbols) // _PER_WORD)
    weight = F.array(*[F.lit(_scaled(c * math.log2(c)) if c else 0) for c in range(WINDOW + 1)])
    most = _scaled(WINDOW * (math.log2(WINDOW) - least))
    ids = F.transform(F.split(candidate, ""), lambda c: F.instr(F.lit(symbols), c) - 1)
    zero = F.array_repeat(F.lit(0).cast("long"), words)
    start = F.struct(F.lit(0).alias("i"), F.lit(0).alias("run"), zero.alias("counts"), F.lit(0).cast("long").alias("sum"),
                     F.lit(None).cast("int").alias("first"), F.lit(None).cast("int").alias("end"))

    def word(x):
        return F.floor(x / _PER_WORD).cast("int")

    def one(x):
        return F.call_function("shiftleft", F.lit(1).cast("long"), x % _PER_WORD * _BITS)

    def count(counts, x):
        return F.call_function("shiftright", F.get(counts, word(x)), x % _PER_WORD * _BITS).bitwiseAND(F.lit((1 << _BITS) - 1)).cast("int")

    def inside(acc, x, gone):
        full = gone.isNotNull()
        held = count(acc["counts"], gone)
        # First the character that leaves, then the one that enters.
        less = F.when(full, acc["sum"] - F.get(weight, held) + F.get(weight, held - 1)).otherwise(acc["sum"])
        now = count(acc["counts"], x) - F.when(gone == x, 1).otherwise(0)
        counts = F.transform(acc["counts"], lambda w, k: w + F.when(k == word(x), one(x)).otherwise(0) - F.when(k == word(gone), one(gone)).otherwise(0))
        run, after = F.least(acc["run"] + 1, F.lit(WINDOW)), acc["i"] + 1
        return once(less - F.get(weight, now) + F.get(weight, now + 1), lambda total: F.struct(
            after.alias("i"), run.alias("run"), counts.alias("counts"), total.alias("sum"),
            F.when((run == WINDOW) & (total <= most), F.coalesce(acc["first"], after - WINDOW)).otherwise(acc["first"]).alias("first"),
            F.when((run == WINDOW) & (total <= most), after).otherwise(acc["end"]).alias("end")))

    def step(acc, x, ids):
        anew = F.struct((acc["i"] + 1).alias("i"), F.lit(0).alias("run"), zero.alias("counts"), F.lit(0).cast("long").alias("sum"),
                        acc["first"].alias("first"), acc["end"].alias("end"))
        gone = F.when(acc["run"] == WINDOW, F.get(ids, acc["i"] - WINDOW))
        return F.when(x < 0, anew).otherwise(once(gone, lambda g: inside(acc, x, g)))
    return once(once(ids, lambda v: F.aggregate(v, start, lambda acc, x: step(acc, x, v))),
                 lambda r: F.struct(r["first"].alias("first"), r["end"].alias("end")))


def _class_spans(worth: Column, kind: str) -> Column:
    symbols, least = CLASSES[kind]
    found = F.transform(worth, lambda x: F.struct(
        x["at"]["start"].alias("zero"), _entropy_range(x["said"], symbols, least).alias("hot")))
    return F.transform(F.filter(found, lambda x: x["hot"]["first"].isNotNull()), lambda x: F.struct(
        (x["zero"] + x["hot"]["first"]).alias("start"), F.lit(KINDS.index(kind)).alias("kind"),
        (x["zero"] + x["hot"]["end"]).alias("end")))


def _high_entropy(text: Column) -> Column:
    """Spans of candidates with enough entropy in a class and no allow-list match."""
    matches = F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0))
    both = F.arrays_zip(_places(text, CANDIDATE, matches).alias("at"), matches.alias("said"))
    worth = F.filter(both, lambda x: x["said"].rlike("[0-9]") & x["said"].rlike("[A-Za-z]") & ~x["said"].rlike(ALLOWED))
    parts = [_class_spans(worth, kind) for kind in CLASSES]
    return F.when(text.rlike(CANDIDATE), F.concat(*parts)).otherwise(F.expr(f"CAST(array() AS {_SPAN})"))


def find(documents: DataFrame) -> DataFrame:
    """The rows with ``base_spans`` and ``all_spans``: arrays of (start, kind number, end) in order."""
    text = F.coalesce(F.col("text"), F.lit(""))
    base = F.concat(_base(text, "assign", ASSIGN, ASSIGN, 6, group=2),
                    _base(text, "access", ACCESS, "AKIA[A-Z0-9]{16}", 20),
                    _base(text, "hex", HEX, "[0-9a-f]{24}", 24))
    return (documents.withColumn("base_spans", F.array_sort(base)).withColumn("all_spans", _high_entropy(text))
            .withColumn("all_spans", once(F.array_sort(F.concat("base_spans", "all_spans")), _not_inside)))


def _not_inside(spans: Column) -> Column:
    """Of sorted spans the base ones and those that no base span before them, or at the same start, reaches over."""
    def reach(at, x):
        return F.greatest(at, F.when(x["kind"] < _BASE, x["end"]).otherwise(0))
    marked = F.zip_with(spans, running(spans, F.lit(0), reach), lambda x, over: F.struct(x.alias("span"), over.alias("over")))
    return F.transform(F.filter(marked, lambda m: (m["span"]["kind"] < _BASE) | (m["span"]["end"] > m["over"])), lambda m: m["span"])


def _written(spans: str) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(documents: DataFrame) -> DataFrame:
    """One row per document: counts of the base kinds, the hash of the base spans, and all spans."""
    def count(k):
        return F.size(F.filter("base_spans", lambda s: s["kind"] == k)).cast("long")
    return find(documents.select("doc_id", "text")).select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(_written("base_spans"), 256).alias("base_sha256"), _written("all_spans").alias("spans"))


def redact(documents: DataFrame, mask: str = MASK) -> DataFrame:
    """The rows with every span of ``text`` replaced by the mask; touching or overlapping spans share one. Further columns
    keep their values, whatever their names; a null text stays null."""
    spans = F.col("all_spans")
    before = running(spans, F.lit(-1), lambda at, s: F.greatest(at, s["end"]))
    # A span that starts behind all ends before it begins a mask, which goes on to the last end before the next such span.
    met = F.zip_with(spans, F.concat(F.array(F.lit(-1)), before), lambda s, end: F.struct(s["start"].alias("start"), end.alias("end")))
    fresh = F.filter(met, lambda m: m["start"] > m["end"])
    ends = F.concat(F.transform(F.slice(fresh, F.lit(2), F.greatest(F.size(fresh) - 1, F.lit(0))), lambda m: m["end"]), F.array(F.array_max(before)))
    masked = F.zip_with(fresh, ends, lambda m, end: F.struct(m["start"].alias("a"), end.alias("b")))
    clean = F.when(F.size("all_spans") > 0, cut(F.col("text"), masked, mask)).otherwise(F.col("text"))
    return unpacked(find(packed(documents)).withColumn("text", clean), documents.columns)
