"""Indel similarities of names as Arrow-batched functions; each distinct pair of texts is compared once per batch."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def common_length(x: str, y: str) -> int:
    """Length of the longest common subsequence, a column of bits at a time."""
    where: dict[str, int] = {}
    for i, ch in enumerate(x):
        where[ch] = where.get(ch, 0) | 1 << i
    full = (1 << len(x)) - 1
    rows = full
    for ch in y:
        hits = rows & where.get(ch, 0)
        rows = ((rows + hits) | (rows - hits)) & full
    return len(x) - rows.bit_count()


def ratio(x: str, y: str) -> float:
    """Twice the common subsequence over both lengths, in per cent; 100 for two empty texts."""
    total = len(x) + len(y)
    return 200.0 * common_length(x, y) / total if total else 100.0


def token_sort(x: str, y: str) -> float:
    return ratio(" ".join(sorted(x.split())), " ".join(sorted(y.split())))


def token_set(x: str, y: str) -> float:
    """100 if one side's words hold the other's; else the best of the common words with and without each rest."""
    a, b = set(x.split()), set(y.split())
    if not a or not b:
        return 0.0
    both, left, right = " ".join(sorted(a & b)), " ".join(sorted(a - b)), " ".join(sorted(b - a))
    if both and (not left or not right):
        return 100.0
    with_left, with_right = f"{both} {left}".strip(), f"{both} {right}".strip()
    best = ratio(with_left, with_right)
    return max(best, ratio(both, with_left), ratio(both, with_right)) if both else best


def name_similarity(x: str, y: str) -> float:
    """The larger of the plain ratio and the mean of both token ratios, from 0 to 1."""
    return max(ratio(x, y), (token_set(x, y) + token_sort(x, y)) / 2) / 100.0


def best_similarity(xs, ys) -> float:
    """Largest similarity of any variant of one name to any of the other; 0 if either has none."""
    return max((name_similarity(x, y) for x in xs for y in ys), default=0.0)


#: Texts of at most so many bytes fit into a word of bits; pairs compared at once.
_BITS, _CHUNK = 64, 4096


def common_lengths(xs: list[str], ys: list[str]) -> np.ndarray:
    """``common_length`` of many pairs, a column of bits at a time for all of them; long or other than ASCII texts singly."""
    out = np.zeros(len(xs), dtype=np.int64)
    plain = np.array([len(x) <= _BITS and len(y) <= _BITS and x.isascii() and y.isascii() and "\0" not in x and "\0" not in y for x, y in zip(xs, ys, strict=True)], dtype=bool)
    for k in np.flatnonzero(~plain):
        out[k] = common_length(xs[k], ys[k])
    chosen = np.flatnonzero(plain)
    sizes = np.array([len(xs[k]) + len(ys[k]) for k in chosen], dtype=np.int64)
    chosen = chosen[np.argsort(sizes, kind="stable")]  # texts of like length end together
    for at in range(0, len(chosen), _CHUNK):
        part = chosen[at : at + _CHUNK]
        bytes_of = lambda texts: np.array([texts[k] for k in part], dtype=f"S{_BITS}").view(np.uint8).reshape(len(part), _BITS)  # noqa: B023, E731
        a, b = bytes_of(xs), bytes_of(ys)
        long_a, long_b = (a != 0).sum(axis=1), (b != 0).sum(axis=1)
        a, b = a[:, : long_a.max(initial=0)].T, b[:, : long_b.max(initial=0)].T
        seen = np.bincount(a.ravel(), minlength=256) > 0
        seen[0] = False
        code = np.where(seen, np.cumsum(seen), 0)  # 0: the end of a text, or a letter of no first text
        where, row = np.zeros((seen.sum() + 1) * len(part), dtype=np.uint64), np.arange(len(part))
        for i, at in enumerate(code[a] * len(part) + row):
            where[at] |= np.uint64(1) << np.uint64(i)
        where[: len(part)] = 0
        rows = np.full(len(part), ~np.uint64(0))
        for at in code[b] * len(part) + row:
            hits = rows & where[at]
            rows = (rows + hits) | (rows - hits)
        full = np.where(long_a == _BITS, ~np.uint64(0), (np.uint64(1) << (long_a % _BITS).astype(np.uint64)) - np.uint64(1))
        out[part] = long_a - np.bitwise_count(rows & full)
    return out


def name_similarities(xs: list[str], ys: list[str]) -> np.ndarray:
    """``name_similarity`` of many pairs: the common subsequences of all are found together."""
    parts: dict[str, tuple[str, frozenset, str]] = {}

    def of(text: str) -> tuple[str, frozenset, str]:
        if text not in parts:
            words = text.split()
            parts[text] = (" ".join(sorted(words)), frozenset(words), " ".join(sorted(set(words))))
        return parts[text]

    asked: dict[tuple[str, str], int] = {}
    ask = lambda x, y: asked.setdefault((x, y), len(asked))
    plain, ordered, rests, fixed = [], [], [], []
    for x, y in zip(xs, ys, strict=True):
        (sx, a, ux), (sy, b, uy) = of(x), of(y)
        plain.append(ask(x, y))
        ordered.append(ask(sx, sy))
        common = a & b
        if not a or not b:
            rest, known = -1, 0.0
        elif not common:
            rest, known = ask(ux, uy), 0.0
        elif len(common) == len(a) or len(common) == len(b):
            rest, known = -1, 100.0
        else:
            both = " ".join(sorted(common))
            left, right = f"{both} {' '.join(sorted(a - b))}", f"{both} {' '.join(sorted(b - a))}"
            rest, known = ask(left, right), max(200.0 * len(both) / (len(both) + len(left)), 200.0 * len(both) / (len(both) + len(right)))
        rests.append(rest)
        fixed.append(known)
    first, second = [x for x, _ in asked], [y for _, y in asked]
    total = np.array([len(x) + len(y) for x, y in asked], dtype=np.int64)
    ratios = np.where(total > 0, 200.0 * common_lengths(first, second) / np.maximum(total, 1), 100.0)
    ratios = np.append(ratios, 0.0)  # at -1: nothing asked
    return np.maximum(ratios[plain], (np.maximum(fixed, ratios[rests]) + ratios[ordered]) / 2) / 100.0 if xs else np.zeros(0)


def letter_bits(name: Column) -> Column:
    """64 bits of a normalised name: the letters and digits in it, and the letters that are in it twice. Each bit by which two
    names differ is a letter that one of them must lose on the way to the other."""
    code = lambda c: F.when(c.between("a", "z"), F.ascii(c) - 97).when(c.between("0", "9"), F.ascii(c) - 22)
    bit = lambda k: F.call_function("shiftleft", F.lit(1).cast("bigint"), k)
    none = F.lit(0).cast("bigint")
    add = lambda s, k: s.bitwiseOR(F.when(s.bitwiseAND(bit(k)) == 0, bit(k)).when(k < 26, bit(k + 36)).otherwise(none))
    return F.aggregate(F.array_compact(F.transform(F.split(name, ""), code)), none, add)


def word_bits(name: Column) -> Column:
    """64 bits of a normalised name: one for each of its words; all bits if a word is in it twice or two share a bit. Names share
    at most as many words as bits."""
    bit = lambda w: F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(F.xxhash64(w), F.lit(64)).cast("int"))
    words = F.split(name, " ")
    bits = F.aggregate(words, F.lit(0).cast("bigint"), lambda s, w: s.bitwiseOR(bit(w)))
    return F.when(F.bit_count(bits) < F.size(words), F.lit(-1).cast("bigint")).otherwise(bits)


def name_sizes(name: Column) -> Column:
    """Length of a normalised name and of its longest word, in one number."""
    return F.length(name) * 4096 + F.array_max(F.transform(F.split(name, " "), lambda w: F.length(w)))


def highest_similarity(a: str, b: str) -> Column:
    """What the similarity of two non-empty normalised names can't exceed, from columns <a>letters, <a>words and <a>sizes: no
    ratio exceeds the share of letters that needn't be lost, and that of the common words no more than so many words can make up."""
    length = [F.shiftright(f"{m}sizes", 12) for m in (a, b)]
    longest = F.least(*[F.col(f"{m}sizes").bitwiseAND(4095) for m in (a, b)])
    lost = F.greatest(F.bit_count(F.col(f"{a}letters").bitwiseXOR(F.col(f"{b}letters"))), F.abs(length[0] - length[1]))
    kept = 1.0 - lost / (length[0] + length[1])
    shared = F.bit_count(F.col(f"{a}words").bitwiseAND(F.col(f"{b}words")))
    common = F.least(shared * (longest + 1) - 1, *length)
    return F.when(shared == 0, kept).otherwise((kept + F.greatest(kept, 2.0 * common / (common + F.least(*length)))) / 2)


def _texts(measure):
    @F.pandas_udf("double")
    def column(a: pd.Series, b: pd.Series) -> pd.Series:
        known: dict = {}
        return pd.Series([None if x is None or y is None else known[x, y] if (x, y) in known else known.setdefault((x, y), measure(x, y)) for x, y in zip(a, b, strict=True)], dtype="float64")

    return column


def similarity_columns() -> dict:
    """Column functions of two text columns; built on use, since they need a running session."""
    return {"ratio": _texts(ratio), "token_sort": _texts(token_sort), "token_set": _texts(token_set), "name_sim": _texts(name_similarity)}


def variants_column():
    """Column function of two columns of normalised name variants, none of them empty, a line each: ``best_similarity``, for all
    rows of a batch together."""

    @F.pandas_udf("double")
    def column(a: pd.Series, b: pd.Series) -> pd.Series:
        known: dict[tuple[str, str], int] = {}
        at = [known.setdefault(key, len(known)) for key in zip(a, b, strict=True)]
        pairs = [(k, x, y) for (xs, ys), k in known.items() if xs and ys for x in xs.split("\n") for y in ys.split("\n")]
        best = np.zeros(len(known))
        np.maximum.at(best, np.array([k for k, _, _ in pairs], dtype=np.int64), name_similarities([x for _, x, _ in pairs], [y for _, _, y in pairs]))
        return pd.Series(best[at] if at else best, dtype="float64")

    # told to be nondeterministic so that filters on it aren't pushed below it with all that they are made of written out
    return column.asNondeterministic()
