"""Token counts of whole texts, huge ones by overlapping chunks that are spliced.

A text of up to ``HUGE`` characters is encoded at once. A longer one is cut into chunks that
overlap their neighbours, each encoded with the offsets of its tokens. Two neighbours are
spliced in their overlap at a character boundary that is

* stable: no piece of the vocabulary equals a stretch of the text across it. Merges only make
  pieces of the vocabulary, so none ever crosses it, in a chunk or in the whole text, and what
  stands on its two sides is encoded independently; and
* common: tokens of both chunks begin there.

Both chunks hold more text on each side of it than the longest piece, so they see what the
whole text would show there. If an overlap has no such boundary, it is widened, up to the
whole text, so counts are exact for every text. The normalizer must keep characters one by one
(checked when the model is loaded); otherwise texts are encoded at once.

In every case: no text or an empty one: no tokens; rows are counted each by itself; invalid
UTF-8 counts with replacement characters; extra columns are passed on.
"""

from __future__ import annotations

import functools

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dqloom.llm import common as c

HUGE = 16_384
CHUNK = 8_192
OVERLAP = 128
LIMIT = 4096
_MARK = "▁"  # stands for a space in pieces


class Counter:
    """A sentencepiece model and what splicing needs to know of it."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = model = SentencePieceProcessor(model_file=path)
        special = (model.is_byte, model.is_control, model.is_unknown, model.is_unused)
        ids = (i for i in range(model.get_piece_size()) if not any(f(i) for f in special))
        self.pieces = {p for p in map(model.id_to_piece, ids) if len(p) > 1}
        self.longest = max(map(len, self.pieces), default=1)
        probes = [f"a{x}a" for x in ("½", "ﬁ", "Å", "\u3000", "\t", "\n", "  ", "   ")]
        self.keeps = all(model.decode(model.encode(p)) == p for p in probes)

    def _offsets(self, text: str) -> list[int]:
        return [a for a, _ in self.model.encode(text, return_type="offset_mapping")["offsets"]]

    def stable(self, text: str, at: int) -> bool:
        low, high = max(0, at - self.longest + 1), min(len(text), at + self.longest - 1)
        near = text[low:high].replace(" ", _MARK)
        at -= low
        return not any(
            near[a:b] in self.pieces for a in range(at) for b in range(at + 1, min(len(near), a + self.longest) + 1)
        )

    def splices(self, text: str, chunk: int, overlap: int) -> int:
        """Tokens of a text, chunk by chunk."""
        total, start = 0, 0  # tokens before ``start``, a boundary of the whole text
        begins = 0  # of the chunk that is being counted
        end = min(len(text), chunk + overlap)
        here = self._offsets(text[:end])
        while True:
            here = np.asarray(here, np.int64) + begins
            if end == len(text):
                return total + int((here >= start).sum())
            width, more = overlap, chunk
            while True:  # the next chunk, wider until its tokens meet those of this one
                margin = self.longest + 1
                next_begins = max(start, end - 2 * width - 2 * margin)
                next_end = min(len(text), end + chunk)
                there = np.asarray(self._offsets(text[next_begins:next_end]), np.int64) + next_begins
                both = np.intersect1d(here, there)
                both = both[(both > max(start, next_begins + margin)) & (both < end - margin)]
                at = next((int(p) for p in both[::-1] if self.stable(text, int(p))), None)
                if at is not None:
                    break
                if next_begins <= start:  # nothing left to widen: this chunk takes more text
                    end = min(len(text), end + more)
                    more *= 2  # so that a text without such a boundary is encoded a few times, not once a chunk
                    here = np.asarray(self._offsets(text[begins:end]), np.int64) + begins
                    if end == len(text):
                        return total + int((here >= start).sum())
                else:
                    width *= 2
            total += int(((here >= start) & (here < at)).sum())
            start, begins, end, here = at, next_begins, next_end, there - next_begins

    def count(self, text: str, huge: int = HUGE, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
        if len(text) <= huge or not self.keeps:
            return len(self.model.encode(text))
        return self.splices(text, chunk, overlap)


@functools.lru_cache(2)
def counter(path: str) -> Counter:
    return Counter(path)


def counted(docs: DataFrame, path: str, limit: int = LIMIT, text: str = "text") -> DataFrame:
    """``docs`` with a struct ``tokens``: ``n_bytes``, ``n_tokens``, ``over_limit``.

    ``path``: the model file, at the same place on every executor.
    """
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    where = f"c{names.index(text)}"
    schema = plain.withColumn("tokens", F.lit(None).cast("struct<n_bytes:long,n_tokens:long,over_limit:boolean>")).schema

    def count(frames):
        model = counter(path)
        for frame in frames:
            found = []
            for value in frame[where]:
                raw = value.encode() if isinstance(value, str) else value or b""
                n = model.count(raw.decode("utf-8", "replace"))
                found.append({"n_bytes": len(raw), "n_tokens": n, "over_limit": n > limit})
            frame["tokens"] = found
            yield frame

    return plain.mapInPandas(count, schema).transform(c.under, names, "tokens")
