"""Quality rules: lines are content or boilerplate, by a linear-chain random field.

Each line of a text has features (``FEATURES``); the score of content against boilerplate is
their weighted sum, and neighbouring lines gain ``STAY`` if they have the same label. The
Viterbi path labels all lines of a text at once; a text is kept if lines of content hold
at least ``CONTENT_SHARE`` of the characters of its words and the base rules do not fail.

The weights are parameters, chosen by reading, and no labels are used. All counts are made
for whole batches of texts with array operations; nothing is shuffled, and a text is worked on
whole, by one task.

In every case: no text or an empty one: no words, so the base rules fail; ``\\n`` alone ends a
line; repeated rows are judged each by itself; extra columns are passed on.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dqloom.llm import common as c

# Score for content (above 0) or boilerplate (below) of a line, by feature.
FEATURES = {
    "bias": 2.0,
    "symbols": -45.0,  # of #*$%&|<> for each character of a word
    "shouted": -6.0,  # capitals above half of the letters, doubled
    "exclaimed": -8.0,  # ! for each word
    "letterless": -3.0,  # no letter
    "repeated": -2.5,  # an earlier line is equal
    "stuttered": -12.0,  # words equal to the one before, for each word
    "fragment": -0.5,  # under three words without an end of sentence
}
STAY = 0.75
CONTENT_SHARE = 0.5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
SPAN = 5
FIELDS = "n_words:long,word_chars:long,n_symbols:long,n_dup_lines:long,n_repeat_words:long,base_failed:boolean,content_share:double,kept:boolean,boilerplate:array<int>"

_BYTES = np.arange(256)
_SPACE = np.isin(_BYTES, [32, 9, 10, 11, 12, 13])
_LEADS = (_BYTES < 0x80) | (_BYTES >= 0xC0)
_CLASSES = {
    "chars": ~_SPACE & _LEADS,
    "symbols": np.isin(_BYTES, list(b"#*$%&|<>")),
    "capitals": (_BYTES >= 65) & (_BYTES <= 90),
    "letters": (_BYTES >= 65) & (_BYTES <= 90) | (_BYTES >= 97) & (_BYTES <= 122),
    "wide": _BYTES >= 0xC0,
    "exclaimed": _BYTES == 33,
}
# Whether two bytes are a capital beyond ASCII, such as those of Greek and Cyrillic.
_CAPITALS = np.zeros(1 << 16, bool)
_CAPITALS[[int.from_bytes(chr(i).encode()) for i in range(0x80, 0x800) if chr(i).isupper()]] = True


def _counts(flags: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[ends] - sums[starts]


def viterbi(scores: list[float], stay: float = STAY) -> list[bool]:
    """Whether each item is content on the best path; equal paths: content."""
    good, bad, back = scores[0], 0.0, []
    for score in scores[1:]:
        from_good, from_bad = good + stay >= bad, bad + stay > good
        back.append((from_good, not from_bad))  # whether the one before was content
        good, bad = (good + stay if from_good else bad) + score, bad + stay if from_bad else good
    label = good >= bad
    path = [label]
    for to_good, to_bad in reversed(back):
        label = to_good if label else to_bad
        path.append(label)
    return path[::-1]


def judged(batch: list[bytes]) -> list[tuple]:
    """A tuple in the order of ``FIELDS`` for each text."""
    joined = np.frombuffer(b"".join(t + b"\n" for t in batch), np.uint8)
    sizes = np.array([len(t) + 1 for t in batch], np.int64)
    ends = np.cumsum(sizes)
    breaks = np.flatnonzero(joined == 10)
    starts = np.append(0, breaks[:-1] + 1)
    text_of = np.searchsorted(ends, breaks, "right")
    per = {name: _counts(flags[joined], starts, breaks) for name, flags in _CLASSES.items()}
    pairs = joined[:-1].astype(np.uint16) << 8 | joined[1:]
    per["capitals"] += _counts(np.append(_CAPITALS[pairs], False), starts, breaks)
    solid = ~_SPACE[joined]
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    per["words"] = _counts(begins, starts, breaks)

    words = [w for t in batch for w in t.split()]
    symbols = c.word_hashes(words)
    same = np.zeros(len(words), bool)
    same[1:] = symbols[1:] == symbols[:-1]
    line_of = np.repeat(np.arange(len(breaks)), per["words"])
    same[1:] &= line_of[1:] == line_of[:-1]
    stuttered = np.bincount(line_of[same], minlength=len(breaks))
    n_words = np.bincount(text_of, per["words"], len(batch)).astype(np.int64)

    covered = np.zeros(len(words) + 1, np.int64)
    spans = c.Windows(symbols).every(SPAN)
    word_text = np.repeat(np.arange(len(batch)), n_words)
    whole = np.flatnonzero(word_text[: len(spans)] == word_text[SPAN - 1 :][: len(spans)]) if len(spans) else np.empty(0, np.int64)
    if len(whole):
        order = whole[np.lexsort((spans[whole], word_text[whole]))]
        equal = (spans[order[1:]] == spans[order[:-1]]) & (word_text[order[1:]] == word_text[order[:-1]])
        twice = order[np.append(equal, False) | np.append(False, equal)]
        np.add.at(covered, twice, 1)
        np.add.at(covered, twice + SPAN, -1)
    repeat = np.bincount(word_text[np.cumsum(covered[:-1]) > 0], minlength=len(batch))

    again = np.zeros(len(breaks), bool)
    at = 0
    for t in batch:
        seen = set()
        for line in t.split(b"\n"):
            if line in seen:
                again[at] = True
            else:
                seen.add(line)
            at += 1
    again &= per["words"] > 0

    chars, count = np.maximum(per["chars"], 1), np.maximum(per["words"], 1)
    letters = per["letters"] + per["wide"]
    stop = np.isin(joined[np.maximum(breaks - 1, 0)], list(b".!?:;"))
    features = {
        "bias": 1.0,
        "symbols": per["symbols"] / chars,
        "shouted": np.maximum(0, per["capitals"] / np.maximum(letters, 1) - 0.5) * 2 * (letters > 3),
        "exclaimed": per["exclaimed"] / count,
        "letterless": letters == 0,
        "repeated": again,
        "stuttered": stuttered / count,
        "fragment": (per["words"] < 3) & ~stop,
    }
    scores = sum(FEATURES[name] * value for name, value in features.items()) * np.ones(len(breaks))
    firsts = np.searchsorted(text_of, np.arange(len(batch) + 1))
    out = []
    for i in range(len(batch)):
        a, b = firsts[i], firsts[i + 1]
        mine = scores[a:b]
        # labels all agree where all scores do: no path can gain by changing
        content = np.ones(b - a, bool) if (mine >= 0).all() else np.array(viterbi(mine.tolist()))
        word_chars = int(per["chars"][a:b].sum())
        share = float(per["chars"][a:b][content].sum() / word_chars) if word_chars else 0.0
        failed = bool(n_words[i] < MIN_WORDS or 100 * repeat[i] > MAX_REPEAT_PERCENT * n_words[i])
        out.append((
            int(n_words[i]), word_chars, int(per["symbols"][a:b].sum()), int(again[a:b].sum()), int(repeat[i]),
            failed, share, not failed and share >= CONTENT_SHARE, np.flatnonzero(~content).tolist(),
        ))
    return out


def marked(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with a struct ``rules`` of ``FIELDS``; ``boilerplate``: numbers of lines."""
    names = docs.columns
    where = f"c{names.index(text)}"
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    schema = plain.withColumn("rules", F.lit(None).cast(f"struct<{FIELDS}>")).schema
    fields = [x.split(":")[0] for x in FIELDS.split(",")]

    def judge(frames):
        for frame in frames:
            batch = pd.DataFrame({"text": [t.encode() if isinstance(t, str) else t for t in frame[where]]})
            results = [r for piece in c.chunks(iter([batch])) for r in judged(piece["text"].tolist())]
            frame["rules"] = [dict(zip(fields, r)) for r in results]
            yield frame
        c.forget_words()

    return c.in_small_batches(plain).mapInPandas(judge, schema).transform(c.under, names, "rules")


def kept(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their own columns."""
    names = docs.columns
    found = marked(docs.toDF(*[f"c{i}" for i in range(len(names))]), f"c{names.index('text')}")
    return found.where("rules.kept").drop("rules").toDF(*names)
