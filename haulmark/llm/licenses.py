"""Licence scan: an Aho-Corasick automaton over word text, and a parser for licence expressions.

A text is reduced to its words (A-Z as a-z, letters, digits and characters beyond ASCII) joined by single
spaces, and the automaton looks for phrases with a space at either end, so a phrase matches whole words in a
row and overlapping places are all found. After an identifier tag the rest of the line is read as an
expression: a shunting-yard parser turns it into postfix order (WITH binds tighter than AND, AND than OR) and
evaluates it to the labels named and to how binding the whole is.

``score`` is the strength of the evidence: one minus the product of what each label leaves open.

Defined cases: null, empty and wordless texts have no places, empty label lists, null positions and score 0.
An expression that does not parse contributes the licences it names and no more. Ties and repeated rows give equal rows.
"""

from __future__ import annotations

import re

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from haulmark.llm.common import map_batches, record_batch

# Phrases that count as base places, and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
# Further identifiers and notice phrases, as words, and their labels.
FURTHER = {
    "mit license": "mit", "apache license": "apache", "apache 2 0": "apache", "apache license version 2 0": "apache-2.0",
    "bsd license": "bsd", "bsd 2 clause": "bsd-2-clause", "bsd 3 clause": "bsd-3-clause", "isc license": "isc",
    "mozilla public license": "mpl", "mpl 2 0": "mpl-2.0", "eclipse public license": "epl",
    "lesser general public license": "lgpl", "affero general public license": "agpl",
    "gpl 2 0": "gpl-2.0", "gpl 3 0": "gpl-3.0", "lgpl 2 1": "lgpl-2.1", "lgpl 3 0": "lgpl-3.0", "agpl 3 0": "agpl-3.0",
    "cc by nc": "cc-by-nc", "cc by sa": "cc-by-sa", "cc by nd": "cc-by-nd", "cc0": "cc0", "unlicense": "unlicense",
    "public domain": "public-domain", "spdx license identifier": "spdx-tag",
}
# Identifiers that an expression may name, and how binding each is (0 free, 1 notice, 2 shares alike, 3 closed).
BINDING = {
    "0bsd": 0, "cc0-1.0": 0, "unlicense": 0, "mit": 1, "isc": 1, "bsd-2-clause": 1, "bsd-3-clause": 1,
    "apache-2.0": 1, "cc-by-4.0": 1, "zlib": 1, "mpl-2.0": 2, "epl-2.0": 2, "lgpl-2.1": 2, "lgpl-3.0": 2,
    "gpl-2.0": 2, "gpl-3.0": 2, "agpl-3.0": 2, "cc-by-sa-4.0": 2, "cc-by-nc-4.0": 3, "proprietary": 3,
}
_LEVELS = ("free", "notice", "share-alike", "closed")
_STRENGTH = {"spdx-tag": 0.9, "reserved": 0.6}
_USUAL_STRENGTH = 0.7
_RANK = {"or": 1, "and": 2, "with": 3}

SCHEMA = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
          "labels string, score double, expressions array<string>")
_TAG = re.compile(r"spdx-license-identifier[\x20\t]*:[\x20\t]*([^\r\n]*)", re.IGNORECASE | re.ASCII)
_TOKEN = re.compile(r"\(|\)|[A-Za-z0-9.+-]+")
_BYTES = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 0x20
               for b in range(256))


class BadExpression(ValueError):
    pass


def postfix(expression: str) -> list[str]:
    """Shunting-yard: the operands and operators of an expression in postfix order, lower-cased."""
    out, held, operand = [], [], True
    for token in (t.lower() for t in _TOKEN.findall(expression)):
        if token == "(" and operand:
            held.append(token)
        elif token == ")" and not operand:
            while held and held[-1] != "(":
                out.append(held.pop())
            if not held:
                raise BadExpression(expression)
            held.pop()
        elif token in _RANK and not operand:
            while held and held[-1] != "(" and _RANK[held[-1]] >= _RANK[token]:
                out.append(held.pop())
            held.append(token)
            operand = True
        elif token not in _RANK and token not in "()" and operand:
            out.append(token)
            operand = False
        else:
            raise BadExpression(expression)
    if operand or "(" in held:
        raise BadExpression(expression)
    return out + held[::-1]


def evaluate(expression: str) -> tuple[set[str], int]:
    """The licences named, and how binding the whole is: OR takes the freer side, AND the stricter one, and an
    exception after WITH relaxes its licence by one level. Unknown identifiers count as closed."""
    stack: list[tuple[set[str], int]] = []
    for token in postfix(expression):
        if token in _RANK:
            (right, b), (left, a) = stack.pop(), stack.pop()
            if token == "with":
                stack.append((left, max(a - 1, 1)))
            else:
                stack.append((left | right, min(a, b) if token == "or" else max(a, b)))
        else:
            plain = re.sub(r"(-only|-or-later|\+)$", "", token)
            stack.append(({plain}, BINDING.get(plain, 3)))
    return stack[0]


def _named(line: str) -> tuple[set[str], str | None]:
    """Labels of the longest start of a line that parses, and its outcome."""
    tokens = _TOKEN.findall(line)
    # An expression alternates operands and operators; what follows it in the line is prose.
    size, operand = 0, True
    for token in tokens:
        low = token.lower()
        if operand and low in _RANK or not operand and low not in _RANK and low != ")":
            break
        operand = operand if low in "()" else not operand
        size += 1
    expression = " ".join(tokens[:size])
    try:
        names, level = evaluate(expression)
        return names, f"{expression} = {_LEVELS[level]}"
    except BadExpression:
        return {n for n in (t.lower() for t in tokens[:size]) if n in BINDING}, None


def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for phrase, label in (BASE | FURTHER).items():
        found.add_word(f" {phrase} ", (len(phrase) + 1, label, phrase in BASE))
    found.make_automaton()
    return found


def scan_text(value: str, phrases: ahocorasick.Automaton) -> tuple:
    """One text's result, in the order of the schema after doc_id."""
    words = value.encode("utf-8", "surrogatepass").translate(_BYTES).split()
    spaced = f" {b' '.join(words).decode('utf-8', 'surrogatepass')} "
    base, labels, n_base, first, last, seen, at = set(), set(), 0, None, None, 0, 0
    for end, (length, label, is_base) in phrases.iter(spaced):
        labels.add(label)
        if is_base:
            start = end - length  # the blank in front of the phrase
            step = spaced.count(" ", at, start) if start >= at else -spaced.count(" ", start, at)
            seen, at = seen + step, start
            n_base, first, last = n_base + 1, seen if first is None else min(first, seen), seen if last is None else max(last, seen)
            base.add(label)
    outcomes = []
    if "spdx-tag" in labels:
        for line in _TAG.findall(value):
            names, outcome = _named(line)
            labels |= names
            outcomes += [outcome] if outcome else []
    left = float(np.prod([1 - _STRENGTH.get(label, _USUAL_STRENGTH) for label in labels]))
    return len(words), n_base, first, last, ",".join(sorted(base)), ",".join(sorted(labels)), 1 - left, outcomes


def scan(documents: DataFrame) -> DataFrame:
    """One row per document: words, base places, labels, score and evaluated expressions."""
    def each(batch):
        phrases = automaton()
        rows = [scan_text(v or "", phrases) for v in batch.column(1).to_pylist()]
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.list_(pa.string()))
        names = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "expressions")
        yield record_batch(doc_id=batch.column(0), **{
            name: pa.array([r[k] for r in rows], kind) for k, (name, kind) in enumerate(zip(names, kinds, strict=True))})
    return map_batches(documents.select("doc_id", "text"), SCHEMA, each)
