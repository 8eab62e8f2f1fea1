"""Token-set similarity of names and the join keys that make it searchable.

Score (0..100): split both texts into distinct sorted tokens, take the shared part ``I``
and the two remainders. A side without remainder scores 100 when ``I`` is not empty.
Otherwise the score is the best insert/delete similarity among ``I+A`` vs ``I+B`` and,
when ``I`` is not empty, ``I`` vs each of them. Similarity of strings x, y is
``100 * (1 - indel / (|x| + |y|))`` with ``indel = |x| + |y| - 2 * LCS(x, y)``.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from functools import lru_cache
from hashlib import blake2b
from itertools import combinations

import pandas as pd
from pyspark.sql import Column, functions as F, types as T


def lcs_length(x: str, y: str) -> int:
    """Longest common subsequence, bit-parallel over the positions of ``x``."""
    positions: dict[str, int] = {}
    for i, char in enumerate(x):
        positions[char] = positions.get(char, 0) | (1 << i)
    full = (1 << len(x)) - 1
    state = full
    for char in y:
        hit = state & positions.get(char, 0)
        state = ((state + hit) | (state - hit)) & full
    return len(x) - state.bit_count()


def _indel_score(distance: int, total: int) -> float:
    return 100.0 - 100.0 * distance / total if total else 100.0


@lru_cache(maxsize=1 << 16)
def _tokens(name: str | None) -> frozenset[str]:
    return frozenset((name or "").split())


def token_set_score(a: str | None, b: str | None) -> float:
    tokens_a, tokens_b = _tokens(a), _tokens(b)
    if not tokens_a or not tokens_b:
        return 0.0
    shared = tokens_a & tokens_b
    rest_a = " ".join(sorted(tokens_a - shared))
    rest_b = " ".join(sorted(tokens_b - shared))
    if shared and (not rest_a or not rest_b):
        return 100.0
    prefix = len(" ".join(sorted(shared)))
    gap = 1 if shared else 0
    len_a, len_b = prefix + gap + len(rest_a), prefix + gap + len(rest_b)
    # The shared prefix aligns with itself, so only the remainders cost anything.
    distance = len(rest_a) + len(rest_b) - 2 * lcs_length(rest_a, rest_b)
    best = _indel_score(distance, len_a + len_b)
    if shared:
        best = max(best, _indel_score(gap + len(rest_a), prefix + len_a),
                   _indel_score(gap + len(rest_b), prefix + len_b))
    return best


@F.pandas_udf(T.DoubleType())
def token_set_similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([token_set_score(x, y) for x, y in zip(a, b)], dtype="float64")


# Below this score two similar names need not share enough bigrams to be found by keys.
MIN_THRESHOLD = 200 / 3
#: Second half of a key that stands for a token or a pair of tokens: of the left side's long ones, of the right side's long ones.
LEFT_LONG, RIGHT_LONG = -1, -2


def _hashed(key: str) -> int:
    return int.from_bytes(blake2b(key.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def bigrams(name: str) -> list[int]:
    """Space-padded bigrams of the distinct tokens, each packed into one number with its place among its repeats."""
    seen: dict[int, int] = {}
    packed = []
    for token in sorted(set(name.split())):
        padded = f" {token} "
        for first, second in zip(padded, padded[1:]):
            gram = ord(first) << 21 | ord(second)
            seen[gram] = seen.get(gram, 0) + 1
            packed.append(gram << 21 | seen[gram])
    return packed


def signature(name: str, threshold: float, ranks: Mapping[int, int]) -> tuple[list[int], list[int], list[int]]:
    """``(grams, own, whole)`` of a name, such that of any two names scoring at least ``threshold`` both have the two first of
    all bigrams they share among their ``grams``, or one has a key in ``own`` that the other has in ``whole``.

    Write ``c = threshold / 100``, ``A'`` for the distinct sorted tokens joined by spaces.

    * Large shared part. ``I`` vs ``A'`` reaches ``c`` only if ``|I| >= c / (2 - c) * |A'|`` (a token subset is the case
      ``|I| = |A'|``). Either one token alone is that long, or at least two tokens are shared. Taking tokens longest
      first until one taken token plus all others cannot be long enough, two shared tokens
      must be among the taken ones. ``own`` holds only those; ``whole`` holds all tokens and token pairs.
    * Similar strings. With ``d`` the indel distance, turning one space-padded
      string into the other destroys at most two bigrams per deletion and one per insertion, so
      both share at least ``LCS + 1 - d`` bigrams, whatever the order of their tokens. From
      ``d <= (1 - c)(n + m)`` and ``m >= n c / (2 - c)`` this is at least
      ``n (3c - 2) / (2 - c) + 1``, two or more for ``c > 2/3``. All but ``minimum - 2`` bigrams, in any fixed order, hold at least two of
      the shared ones, and so the first two. ``ranks`` gives the order, the rarest first: bigrams without a rank come before all others.
    """
    if threshold <= MIN_THRESHOLD:
        raise ValueError(f"signatures need a threshold above {MIN_THRESHOLD:.1f}")
    tokens = sorted(set(name.split()), key=lambda t: (-len(t), t))
    if not tokens:
        return [], [], []
    c = threshold / 100.0
    joined = len(tokens) - 1 + sum(map(len, tokens))
    need = c / (2 - c) * joined - 1e-9
    pairs = lambda some: [" ".join(sorted(p)) for p in combinations(some, 2)]

    taken, left_out = [], joined
    for token in tokens:
        taken.append(token)
        left_out -= len(token) + 1
        if len(taken) >= 2 and len(tokens[0]) + 1 + max(left_out, 0) < need:
            break
    own = [*(t for t in tokens if len(t) >= need), *pairs(taken)]

    minimum = math.ceil(joined * (3 * c - 2) / (2 - c) + 1 - 1e-9)
    grams = sorted(bigrams(name), key=lambda g: (ranks.get(g, 0), g))[: joined + 1 - minimum + 2]
    return grams, [*map(_hashed, own)], [*map(_hashed, [*tokens, *pairs(tokens)])]


def profile(name: str) -> tuple[int, int, int, int, int]:
    """Length of the joined token set and bit sets of its letters and bigrams.

    Letters: bit ``k`` of a letter says that it occurs more than ``k`` times (up to four).
    Bigrams, numbered per repeat, are hashed to one bit each.
    """
    tokens = sorted(set(name.split()))
    letters, seen = [0, 0], {}
    for char in "".join(tokens):
        slot = ord(char) % 26
        count = seen[slot] = seen.get(slot, 0) + 1
        if count <= 4:
            letters[slot // 13] |= 1 << (slot % 13 * 4 + count - 1)
    grams = [0, 0]
    for gram in bigrams(name):
        bit = gram * 2654435761 % (1 << 61) % 126
        grams[bit // 63] |= 1 << (bit % 63)
    return len(" ".join(tokens)), *letters, *grams


PROFILE = ["length", "letters_a", "letters_b", "grams_a", "grams_b"]
SIGNATURE = ("grams ARRAY<BIGINT>, own ARRAY<BIGINT>, whole ARRAY<BIGINT>, length INT, letters_a BIGINT, letters_b BIGINT, "
             "grams_a BIGINT, grams_b BIGINT")


def signature_udf(threshold: float, ranks: Mapping[int, int]):
    """Arrow UDF giving each name's signature and profile."""

    @F.pandas_udf(SIGNATURE)
    def signed(names: pd.Series) -> pd.DataFrame:
        rows = [(*signature(n, threshold, ranks), *profile(n)) for n in names]
        return pd.DataFrame(rows, columns=["grams", "own", "whole", *PROFILE])

    return signed


@F.pandas_udf(T.ArrayType(T.LongType()))
def bigrams_of(names: pd.Series) -> pd.Series:
    return pd.Series([bigrams(n) for n in names])


def size_band(length: Column, threshold: float) -> Column:
    """Number of a band of lengths: strings similar enough lie in one band or in neighbouring ones."""
    ratio = (2 - threshold / 100) / (threshold / 100) * (1 + 1e-9)
    return F.floor(F.log(length) / math.log(ratio)).cast("int")


def may_be_similar(left: str, right: str, threshold: float) -> Column:
    """Necessary condition on two profiles for similar strings, a few integer operations.

    With ``d`` the largest indel distance that reaches the threshold: lengths differ by at most ``d``,
    letter counts differ by at most ``d`` in total, and each side has at most
    ``length + 1 - shared`` bigrams the other lacks, where ``shared`` is the bound of the keys.
    Hashed or capped bits only hide differences, so no qualifying pair is refused.
    """
    def part(side: str, name: str) -> Column:
        return F.col(f"{side}.{name}")

    def lacking(a: str, b: str) -> Column:
        return sum((F.bit_count(part(a, g).bitwiseAND(F.bitwise_not(part(b, g)))) for g in ("grams_a", "grams_b")),
                   F.lit(0))

    c = threshold / 100
    n, m = part(left, "length"), part(right, "length")
    distance = (n + m) * (1 - c) + 1e-9
    shared = (n + m) * (3 * c - 2) / 2 + 1 - 1e-9
    letters = sum((F.bit_count(part(left, x).bitwiseXOR(part(right, x))) for x in ("letters_a", "letters_b")), F.lit(0))
    return (F.abs(n - m) <= distance) & (letters <= distance) \
        & (lacking(left, right) <= n + 1 - shared) & (lacking(right, left) <= m + 1 - shared)
