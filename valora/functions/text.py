"""Text expressions that stay inside the JVM."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, functions as F

# --- fixed values: letters Unicode does not decompose into a base letter and a mark ---
_SINGLE = {
    "Ø": "O", "ø": "o", "Ł": "L", "ł": "l", "Đ": "D", "đ": "d", "Ð": "D", "ð": "d",
    "Ħ": "H", "ħ": "h", "ı": "i", "Ŧ": "T", "ŧ": "t", "ĸ": "k", "Ə": "E", "ə": "e",
    "α": "a", "β": "b", "γ": "g", "δ": "d", "ε": "e", "ζ": "z", "η": "e", "ι": "i",
    "κ": "k", "λ": "l", "μ": "m", "ν": "n", "ξ": "x", "ο": "o", "π": "p", "ρ": "r",
    "σ": "s", "ς": "s", "τ": "t", "υ": "u", "ω": "o",
    "а": "a", "б": "b", "в": "v", "г": "g", "д": "d", "е": "e", "з": "z", "и": "i",
    "й": "i", "к": "k", "л": "l", "м": "m", "н": "n", "о": "o", "п": "p", "р": "r",
    "с": "s", "т": "t", "у": "u", "ф": "f", "ы": "y", "э": "e", "і": "i", "ґ": "g",
}
_MULTI = {
    "ß": "ss", "ẞ": "Ss", "Æ": "AE", "æ": "ae", "Œ": "OE", "œ": "oe", "Þ": "Th", "þ": "th",
    "Ŋ": "NG", "ŋ": "ng", "θ": "th", "φ": "ph", "χ": "kh", "ψ": "ps",
    "ж": "zh", "х": "kh", "ц": "ts", "ч": "ch", "ш": "sh", "щ": "shch",
    "ю": "iu", "я": "ia", "ё": "io", "є": "ie", "ї": "yi",
}
# Blocks whose accented letters fold by their canonical decomposition:
# Latin-1 to Latin Extended-B, Greek, Cyrillic, Latin Extended Additional, Greek Extended.
_FOLDED_BLOCKS = [(0x00C0, 0x0250), (0x0370, 0x0530), (0x1E00, 0x2000)]
_SPACES = [0x00A0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0x0085]


def _with_capitals(table: dict[str, str]) -> dict[str, str]:
    out = dict(table)
    for char, ascii_text in table.items():
        upper = char.upper()
        if len(upper) == 1:
            out.setdefault(upper, ascii_text.capitalize())
    return out


def _fold_tables() -> tuple[dict[str, str], dict[str, str]]:
    single, multi = _with_capitals(_SINGLE), _with_capitals(_MULTI)
    for lo, hi in _FOLDED_BLOCKS:
        for code in range(lo, hi):
            char = chr(code)
            if char in single or char in multi:
                continue
            base = "".join(c for c in unicodedata.normalize("NFKD", char) if not unicodedata.combining(c))
            base = "".join(multi.get(c, single.get(c, c)) for c in base)
            if base.isascii() and base.isalpha():
                (single if len(base) == 1 else multi)[char] = base
    for code in _SPACES:
        single[chr(code)] = " "
    return single, multi


_FOLD_SINGLE, _FOLD_MULTI = _fold_tables()
# One private-use placeholder per distinct multi-letter spelling lets a single
# translate pass mark all of them; only the few spellings then need a replace.
_SPELLINGS = sorted(set(_FOLD_MULTI.values()))
_PLACEHOLDER = {spelling: chr(0xE000 + i) for i, spelling in enumerate(_SPELLINGS)}


def ascii_fold(c: Column) -> Column:
    """Transliterate Latin, Greek and Cyrillic letters to ASCII; other text is kept."""
    source = "".join(_FOLD_SINGLE) + "".join(_FOLD_MULTI)
    target = "".join(_FOLD_SINGLE.values()) + "".join(_PLACEHOLDER[v] for v in _FOLD_MULTI.values())
    folded = F.translate(c, source, target)
    spelled = folded
    for spelling in _SPELLINGS:
        spelled = F.replace(spelled, F.lit(_PLACEHOLDER[spelling]), F.lit(spelling))
    return F.when(folded.rlike(r"[\x{E000}-\x{E0FF}]"), spelled).otherwise(folded)


def normalize_name(c: Column) -> Column:
    """Fold to ASCII, lower, keep letters and spaces, collapse spaces, trim. Null stays null."""
    letters = F.regexp_replace(F.lower(ascii_fold(c)), r"[^a-z\s]", "")
    return F.trim(F.regexp_replace(letters, r"\s+", " "))


def full_name(first: Column, last: Column) -> Column:
    """``first last``; a missing part counts as empty text and keeps the space."""
    return F.concat(F.coalesce(first, F.lit("")), F.lit(" "), F.coalesce(last, F.lit("")))


def strip_prefix(c: Column, prefix: str) -> Column:
    return F.when(F.startswith(c, F.lit(prefix)), F.substring(c, len(prefix) + 1, 2**31 - 1)).otherwise(c)


def matches(c: Column, pattern: str, literal: bool = False) -> Column:
    """Case-insensitive containment; the pattern is a regular expression unless ``literal``."""
    lowered = F.lower(c)
    hit = F.contains(lowered, F.lit(pattern.lower())) if literal else lowered.rlike(pattern.lower())
    return F.coalesce(hit, F.lit(False))
