"""Column expressions for entity names and identifiers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Generational suffixes removed from the end of a name.
LONG_SUFFIXES = ("jr", "sr", "viii", "vii", "vi", "iii", "ii", "iv", "v")
SHORT_SUFFIXES = ("jr", "sr", "iii", "ii", "iv")
# Suffixes that may carry a trailing dot.
DOTTED_SUFFIXES = ("jr", "sr")


def _strip(text: Column) -> Column:
    """Trim every kind of Unicode white space, not only blanks."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def normalize_name(name: Column, suffixes: Sequence[str] = LONG_SUFFIXES) -> Column:
    """Lower-case match key: one trailing suffix, dots, apostrophes and repeated spaces removed."""
    endings = "|".join(s + (r"\.?" if s in DOTTED_SUFFIXES else "") for s in suffixes)
    no_suffix = F.regexp_replace(_strip(F.lower(name)), rf"(?U)\b(?:{endings})\s*$", "")
    no_marks = F.translate(no_suffix, ".'", "")
    return _strip(F.regexp_replace(no_marks, r"(?U)\s+", " "))


def _lookup(key: Column, mapping: Mapping[str, str]) -> Column:
    """Value for a key compared as text; NULL when absent."""
    table = F.create_map(*[F.lit(str(x)) for x in chain.from_iterable(mapping.items())])
    return table[key.cast("string")]


def replace_exact(col: Column, mapping: Mapping[str, str]) -> Column:
    """Swap whole values found in ``mapping``; one pass, so replacements never chain."""
    return F.coalesce(_lookup(col, mapping), col) if mapping else col


def override_by_key(key: Column, col: Column, mapping: Mapping[str, str]) -> Column:
    """``mapping[key]`` where present, else ``col``."""
    return F.coalesce(_lookup(key, mapping), col) if mapping else col


def surrogate_id(name: Column, prefix: str = "ds-") -> Column:
    """Readable id built from a name: spaces become dashes, dots vanish."""
    return F.concat(F.lit(prefix), F.translate(F.lower(name), " .", "-"))


def join_names(first: Column, last: Column) -> Column:
    """``"first last"`` without outer white space."""
    return _strip(F.concat(first, F.lit(" "), last))


def name_matches(name: Column, pattern: str) -> Column:
    """Case-insensitive regular-expression search; a missing name never matches."""
    return F.coalesce(F.rlike(name, F.lit("(?i)" + pattern)), F.lit(False))


def has_prefix(col: Column, prefix: str) -> Column:
    """True where the identifier starts with ``prefix``."""
    return F.startswith(col, F.lit(prefix))
