"""SentencePiece encoding and decoding by a streaming Viterbi search over a piece vocabulary.

The best score up to each character extends by the pieces that start there. Only the last ``longest`` positions can
still be extended, and as soon as the backpointer paths of all of them meet in one boundary, the ids before it are
final and leave the window. Positions before which no piece can reach across (a word start, a line break) always
are such boundaries, so the text is cut there and the ids of a stretch are remembered, up to a fixed number of
stretches. A character that no piece covers becomes its UTF-8 bytes.

Decoding joins the pieces' bytes, turns the word mark into a space and removes the one in front.

Defined cases: null and empty texts have no ids. A text that holds the word mark U+2581 itself decodes with spaces in
its place and is reported as not ``exact``; all other texts come back byte for byte. The model file is a parameter.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from haulmark.llm.common import map_batches

MARK = "▁"
REMEMBERED = 400_000
_ADDED = "ids array<int>, n_tokens long, exact boolean"


class Vocabulary:
    def __init__(self, path: str):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces, self.bytes_of, self.byte_id = {}, [], {}
        for k in range(model.get_piece_size()):
            piece = model.id_to_piece(k)
            if model.is_byte(k):
                self.byte_id[int(piece[3:5], 16)] = k
                self.bytes_of.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(k) or model.is_unknown(k) or model.is_unused(k):
                self.bytes_of.append(b"")
            else:
                self.pieces[piece] = (k, model.get_score(k))
                self.bytes_of.append(piece.replace(MARK, " ").encode())
        self.longest = max(map(len, self.pieces))
        #: Every start of a piece, with the id and score of those that are pieces themselves.
        self.starts = {p[:k]: None for p in self.pieces for k in range(1, len(p))} | self.pieces
        self.unknown = min(s for _, s in self.pieces.values()) - 10
        crosses = any(MARK in p.lstrip(MARK) or "\n" in p for p in self.pieces)
        self.stretch = re.compile(".+" if crosses else f"{MARK}+[^{MARK}\n]*|\n|[^{MARK}\n]+", re.DOTALL)
        self.memory: dict[str, tuple[int, ...]] = {}

    def stream(self, chars: str):
        """Ids of a stretch, yielded as soon as they are final."""
        best, back = {0: 0.0}, {}
        done, n = 0, len(chars)
        for at in range(n):
            here = best[at]
            end, covered = at + 1, False
            while end <= n and (hit := self.starts.get(chars[at:end], 0)) != 0:
                if hit:
                    covered |= end == at + 1
                    if end not in best or here + hit[1] > best[end]:
                        best[end], back[end] = here + hit[1], (at, hit[0])
                end += 1
            if not covered and (at + 1 not in best or here + self.unknown > best[at + 1]):
                best[at + 1], back[at + 1] = here + self.unknown, (at, -1)
            if at + 1 - done > 2 * self.longest or at + 1 == n:
                live = {p for p in range(max(done, at + 2 - self.longest), at + 1 + self.longest) if p in best} if at + 1 < n else {n}
                while len(live) > 1:
                    last = max(live)
                    live.remove(last)
                    live.add(back[last][0] if last > done else done)
                meet = live.pop()
                path = []
                where = meet
                while where > done:
                    path.append((back[where], where))
                    where = back[where][0]
                for (start, number), stop in reversed(path):
                    if number >= 0:
                        yield number
                    else:
                        yield from (self.byte_id[b] for b in chars[start:stop].encode("utf-8", "surrogatepass"))
                for p in range(done, meet):
                    best.pop(p, None)
                    back.pop(p, None)
                done = meet

    def short(self, chars: str) -> list[int]:
        """``stream`` for a stretch that fits the window: the paths meet at its end."""
        n, starts, low = len(chars), self.starts, -1e300
        best, back = [0.0] + [low] * n, [(0, 0)] * (n + 1)
        for at in range(n):
            here, end, alone = best[at], at + 1, False
            while end <= n:
                hit = starts.get(chars[at:end], 0)
                if hit is not None:
                    if hit == 0:
                        break
                    if end == at + 1:
                        alone = True
                    total = here + hit[1]
                    if total > best[end]:
                        best[end], back[end] = total, (at, hit[0])
                end += 1
            if not alone and here + self.unknown > best[at + 1]:
                best[at + 1], back[at + 1] = here + self.unknown, (at, -1)
        out: list[int] = []
        while n:
            start, number = back[n]
            if number >= 0:
                out.append(number)
            else:
                out.extend([self.byte_id[b] for b in chars[start:n].encode("utf-8", "surrogatepass")][::-1])
            n = start
        return out[::-1]

    def encode(self, value: str) -> list[int]:
        out: list[int] = []
        if not value:
            return out
        memory = self.memory
        for part in self.stretch.findall(MARK + value.replace(" ", MARK)):
            ids = memory.get(part)
            if ids is None:
                ids = tuple(self.short(part) if len(part) <= 2 * self.longest else self.stream(part))
                if len(memory) >= REMEMBERED:
                    memory.clear()
                if len(part) <= 64:
                    memory[part] = ids
            out.extend(ids)
        return out

    def decode(self, ids) -> bytes:
        table = self.bytes_of
        return b"".join([table[k] for k in ids])[1:]


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def encode(documents: DataFrame, path: str) -> DataFrame:
    """The rows with ids, n_tokens and whether decoding gives the text back."""
    added = ("ids", "n_tokens", "exact")
    rest = documents.drop(*added)

    def each(batch):
        known = vocabulary(path)
        counts, exact, flat = [], [], []
        for value in batch.column(batch.schema.get_field_index("text")).to_pylist():
            ids = known.encode(value or "")
            counts.append(len(ids))
            exact.append(known.decode(ids) == (value or "").encode("utf-8", "surrogatepass"))
            flat.append(np.array(ids, dtype=np.int32))
        ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
        ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(flat or [np.zeros(0, np.int32)])))
        yield pa.RecordBatch.from_arrays([*batch.columns, ids, pa.array(counts, pa.int64()), pa.array(exact)],
                                         names=[*batch.schema.names, *added])
    schema = ", ".join([f"`{name}` {kind}" for name, kind in rest.dtypes] + [_ADDED])
    return map_batches(rest, schema, each)
