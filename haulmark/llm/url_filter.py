"""URL filtering by glob rules, all of them simulated at once as one bit-parallel wildcard automaton.

A glob is matched against the whole canonical URL, host and path in one (``host/path``): ``*`` is any run of bytes
without a slash, ``**`` any run, ``?`` one character that is no slash, a backslash takes the next character as it is.
The states of all globs are packed next to each other into 64-bit words (``Automaton``): a byte moves them by one shift
with carries, an AND with the byte's mask, and an OR of the states whose wildcard lets them stay. The URLs of an Arrow
batch step together, one matrix operation a byte position; the few that are much longer than the rest run one by one
on integers of any length, by the same masks.

Rules come in two lists. ``SITE`` rules are (host, path prefix, verdict): each becomes two globs, one for the host and
one for its subdomains, the longest that fits decides, and its text is returned. ``GLOBS`` decide the URLs that no site
rule fits, again the longest first; of equally long ones the first listed. A URL that nothing fits is allowed.

Defined cases: a null URL or one without ``://`` has an empty host and path, which only a glob for the empty text could
fit. The host is what the contract of the query says: user names and ports stay part of it, letters other than A-Z keep
their case. Query and fragment are never looked at. Very long URLs are read whole. Rows are judged one by one, so
repeated rows and rows without id stay as they are, and an empty table gives no rows. Only the key and the URL are read,
so further columns of any name change nothing. The masks travel with every task and are refused above ``MAX_MASK_BYTES``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulmark.llm.common import map_batches, record_batch

MAX_MASK_BYTES = 64 << 20
LOCKSTEP_BYTES = 1 << 11  # longer URLs leave the common steps
_STATE_BYTES = 16 << 20   # states of the URLs that step together
_SLASH = ord("/")
_FOLLOW = range(0x80, 0xC0)  # UTF-8 bytes behind the first of a character

# The rules of the query's contract.
SITE = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
        ("com", "/fr/", "allow"), ("com", "/de/", "block")]

# Our own: pages that carry no prose, and hosts that only serve them.
GLOBS = [("**.pdf", "block"), ("**.zip", "block"), ("**.exe", "block"), ("**.jpg", "block"), ("**.png", "block"),
         ("spam*/**", "block"), ("*.spam*/**", "block"), ("ads.*/**", "block"), ("*.ads.*/**", "block"),
         ("*/*/login/**", "block"), ("*/login/**", "block"), ("*/cart/**", "block"), ("**/wp-admin/**", "block"),
         ("spam*/about.html", "allow")]


def literal(text: str) -> str:
    """A glob that only fits ``text``."""
    return "".join("\\" + c if c in "*?\\" else c for c in text)


def _tokens(glob: str):
    """("byte", value), ("one", 0), ("run", slashes allowed) of a glob."""
    at = 0
    while at < len(glob):
        c = glob[at]
        if glob.startswith("**", at):
            yield "run", True
            at += 2
            continue
        if c == "*":
            yield "run", False
        elif c == "?":
            yield "one", 0
        else:
            if c == "\\" and at + 1 < len(glob):
                at += 1
                c = glob[at]
            for value in c.encode():
                yield "byte", value
        at += 1


class Automaton:
    """Masks of all globs: where states start, which byte moves into and keeps which state, where they end."""

    def __init__(self, globs: list[str]):
        move, stay, start, end, size = [0] * 256, [0] * 256, 0, [], 0
        for glob in globs:
            state = 1 << size
            start |= state
            for kind, value in _tokens(glob):
                if kind == "run":
                    for b in range(256):
                        if value or b != _SLASH:
                            stay[b] |= state
                    continue
                state <<= 1
                size += 1
                if kind == "byte":
                    move[value] |= state
                else:
                    for b in range(256):
                        if b in _FOLLOW:
                            stay[b] |= state
                        elif b != _SLASH:
                            move[b] |= state
            end.append(size)
            size += 1
        self.words = max(1, -(-size // 64))
        if 2 * 256 * 8 * self.words > MAX_MASK_BYTES:
            raise ValueError(f"{len(globs)} globs need {size} states, more than the masks may hold")
        self.move_bits, self.stay_bits, self.start_bits = move, stay, start
        self.end_bits = sum(1 << e for e in end)
        self.move, self.stay = (np.array([self._split(m) for m in masks]) for masks in (move, stay))
        self.start, self.end = self._split(start), self._split(self.end_bits)
        self.glob_of = {e: i for i, e in enumerate(end)}

    def _split(self, mask: int) -> np.ndarray:
        return np.frombuffer(mask.to_bytes(8 * self.words, "little"), np.uint64)

    def matches(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(text, glob) of every glob that fits a whole text; the texts are slices of ``data``."""
        lengths = np.diff(offsets)
        rows, globs = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        order = np.argsort(-lengths, kind="stable")
        long = int((lengths > LOCKSTEP_BYTES).sum())
        for row in order[:long]:
            found = self._alone(data[offsets[row]:offsets[row + 1]].tobytes())
            rows.append(np.full(len(found), row))
            globs.append(np.array(found, np.int64))
        step = max(1, _STATE_BYTES // (8 * self.words))
        for at in range(long, len(order), step):
            some = order[at:at + step]
            row, glob = self._together(data, offsets[some], lengths[some])
            rows.append(some[row])
            globs.append(glob)
        return np.concatenate(rows), np.concatenate(globs)

    def _alone(self, text: bytes) -> list[int]:
        state = self.start_bits
        for b in text:
            state = (state << 1) & self.move_bits[b] | state & self.stay_bits[b]
            if not state:
                return []
        state &= self.end_bits
        found = []
        while state:
            low = state & -state
            found.append(self.glob_of[low.bit_length() - 1])
            state ^= low
        return found

    def _together(self, data, starts, lengths) -> tuple[np.ndarray, np.ndarray]:
        """Texts by falling length, so that those still running are always the first ones."""
        state = np.tile(self.start, (len(starts), 1))
        running = len(starts)
        for place in range(int(lengths[0]) if len(lengths) else 0):
            running = int(np.searchsorted(-lengths[:running], -place, side="left"))
            byte = data[starts[:running] + place]
            now = state[:running]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            moved &= self.move[byte]
            now &= self.stay[byte]
            now |= moved
        rows, words = np.nonzero(state & self.end)
        left = (state & self.end)[rows, words]
        found_rows, found = [], []
        while len(rows):
            low = left & (~left + np.uint64(1))
            bit = np.frexp(low.astype(np.float64))[1] - 1  # powers of two are exact in a double
            found_rows.append(rows)
            found.append(np.array([self.glob_of[int(w) * 64 + int(b)] for w, b in zip(words, bit)], np.int64))
            left = left ^ low
            more = left != 0
            rows, words, left = rows[more], words[more], left[more]
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return np.concatenate(found_rows), np.concatenate(found)


class Rules:
    """Globs by rising precedence, with the text and the verdict each stands for."""

    def __init__(self, site: list[tuple[str, str, str]], globs: list[tuple[str, str]]):
        listed = [(1, len(host) + len(path), -i, glob, host + path, verdict)
                  for i, (host, path, verdict) in enumerate(site)
                  for glob in (literal(host + path) + "**", "*." + literal(host + path) + "**")]
        listed += [(0, len(glob), -i, glob, None, verdict) for i, (glob, verdict) in enumerate(globs)]
        listed.sort(key=lambda r: r[:3])
        self.globs = [r[3] for r in listed]
        self.rules = [r[4] for r in listed]
        self.verdicts = [r[5] for r in listed]
        self.automaton = Automaton(self.globs)

    def best(self, texts: pa.Array) -> np.ndarray:
        """Place of the deciding glob of each text, -1 where none fits."""
        plain = texts.cast(pa.large_binary())
        _, offsets, data = plain.buffers()
        bounds = np.frombuffer(offsets, np.int64)[plain.offset:plain.offset + len(plain) + 1]
        found = np.full(len(plain), -1)
        rows, globs = self.automaton.matches(np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8), bounds)
        np.maximum.at(found, rows, globs)
        return found


def canonical(url):
    """Host and path columns of a URL column."""
    folded = F.translate(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")),
                         "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return folded.alias("host"), F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit("")).alias("path")


def judge(pages: DataFrame, key: str = "page_id", url: str = "url", site=None, globs=None) -> DataFrame:
    """Key, host, path, rule (the site rule that fits), pattern (the deciding glob) and verdict of every row."""
    rules = Rules(SITE if site is None else site, GLOBS if globs is None else globs)
    named = pages.select(F.col(key).alias("key"), *canonical(F.col(url)))

    def each(batch):
        host, path = batch.column("host"), batch.column("path")
        places = rules.best(pc.binary_join_element_wise(host, path, ""))
        yield record_batch(key=batch.column("key"), host=host, path=path,
                           rule=pa.array([None if p < 0 else rules.rules[p] for p in places], pa.string()),
                           pattern=pa.array([None if p < 0 else rules.globs[p] for p in places], pa.string()),
                           verdict=pa.array(["allow" if p < 0 else rules.verdicts[p] for p in places], pa.string()))

    schema = f"key {named.schema['key'].dataType.simpleString()}, host string, path string, rule string, pattern string, verdict string"
    return map_batches(named, schema, each).withColumnRenamed("key", key)
