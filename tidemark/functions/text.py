"""Text expressions: ASCII policies, repair, summaries, slugs, tokens."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Mapping
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tidemark import constants as K

PY_SPACE_PATTERN = K.PY_SPACE_CLASS + "+"


def strip(col: Column) -> Column:
    """Trim the characters Python treats as white space."""
    return F.btrim(col, F.lit(K.PY_SPACE))


def collapse_space(col: Column) -> Column:
    return strip(F.regexp_replace(col, PY_SPACE_PATTERN, " "))


def is_blank(col: Column) -> Column:
    """Null, empty or white space only."""
    return F.coalesce(F.length(strip(col)), F.lit(0)) == 0


def empty(col: Column) -> Column:
    """Null or the empty string (a falsy string)."""
    return F.coalesce(F.length(col), F.lit(0)) == 0


def count_present(haystack: Column, needles: Iterable[str]) -> Column:
    """How many of the substrings occur at least once."""
    hits = [F.contains(haystack, F.lit(n)).cast("int") for n in needles]
    return reduce(lambda a, b: a + b, hits)


def any_present(haystack: Column, needles: Iterable[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(haystack, F.lit(n)) for n in needles])


def has_non_ascii(col: Column) -> Column:
    return col.rlike(K.NON_ASCII)


def substitute(col: Column, table: Mapping[str, str]) -> Column:
    """Replace characters by strings; one-to-one pairs go through one translate."""
    single = {k: v for k, v in table.items() if len(v) == 1}
    out = F.translate(col, "".join(single), "".join(single.values())) if single else col
    for char, text in table.items():
        if len(text) != 1:
            out = F.replace(out, F.lit(char), F.lit(text))
    return out


# --- ASCII policies ----------------------------------------------------------

# Blocks whose compatibility decomposition is folded by a translate table.
_FOLD_BLOCKS = ((0x80, 0x250), (0x300, 0x400), (0x400, 0x460), (0x1E00, 0x1F00),
                (0x2010, 0x2028), (0x2030, 0x203C))


def _fold_table(unknown: str, skip: Iterable[str]) -> tuple[str, str]:
    """(from, to) for F.translate: accents dropped, unknown characters to ``unknown``.

    Characters that decompose into several characters are left out, so they
    stay non-ASCII and are recognised as needing the general path.
    """
    to_char: list[tuple[str, str]] = []
    drop: list[str] = []
    for lo, hi in _FOLD_BLOCKS:
        for cp in range(lo, hi):
            ch = chr(cp)
            if ch in skip:
                continue
            base = "".join(c for c in unicodedata.normalize("NFKD", ch)
                           if not unicodedata.combining(c))
            if base == "":
                drop.append(ch)
            elif len(base) == 1:
                out = base if base.isascii() else unknown
                if out:
                    to_char.append((ch, out))
                else:
                    drop.append(ch)
    return ("".join(c for c, _ in to_char) + "".join(drop), "".join(t for _, t in to_char))


def _decompose(unknown: str):
    """The general path, for rows with characters outside the folded blocks.

    Built here rather than at module level so that it travels to the executors
    by value and needs nothing installed there.
    """
    def each(text):
        if text is None:
            return None
        parts = unicodedata.normalize("NFKD", text)
        return "".join(c if c.isascii() else unknown for c in parts
                       if not unicodedata.combining(c))

    def batch(column: pd.Series) -> pd.Series:
        return column.map(each)

    return F.pandas_udf(batch, StringType())


def _to_ascii(col: Column, table: Mapping[str, str], unknown: str) -> Column:
    replaced = substitute(col, table)
    folded = F.translate(replaced, *_fold_table(unknown, ()))
    # Only rows with characters outside the folded blocks carry text to Python.
    general = _decompose(unknown)(F.when(has_non_ascii(col) & has_non_ascii(folded), replaced))
    return F.when(has_non_ascii(col), F.coalesce(general, folded)).otherwise(col)


def ascii_clean(col: Column) -> Column:
    """Cleaning policy: substitutions, accents dropped, anything left becomes ``?``."""
    return _to_ascii(col, K.CLEANING_SUBSTITUTIONS, "?")


def ascii_ingest(col: Column) -> Column:
    """Ingest policy: substitutions, accents dropped, anything left removed."""
    return _to_ascii(col, K.INGEST_SUBSTITUTIONS, "")


def ascii_ingest_items(items: Column) -> Column:
    """Ingest policy over an array of strings, nulls kept.

    The items travel as one string, because a Python function cannot run
    inside a higher-order function.
    """
    joined = F.array_join(F.transform(items, lambda s: F.translate(s, "\x1e\x1f", "")),
                          "\x1f", "\x1e")
    parts = F.transform(F.split(ascii_ingest(joined), "\x1f"),
                        lambda s: F.nullif(s, F.lit("\x1e")))
    return F.when(F.size(items) == 0, items).otherwise(parts)


def ascii_publish(col: Column) -> Column:
    """Publishing policy: declared substitutions only; what is left is a violation."""
    return substitute(col, K.PUBLISHING_SUBSTITUTIONS)


def ascii_mask(col: Column) -> Column:
    """Every non-ASCII character becomes one ``?``."""
    return F.regexp_replace(col, K.NON_ASCII, "?")


def normalise_text(col: Column) -> Column:
    """Strip, unify line ends, then the cleaning ASCII policy."""
    lines = F.replace(F.replace(strip(col), F.lit("\r\n"), F.lit("\n")),
                      F.lit("\r"), F.lit("\n"))
    return ascii_clean(lines)


# --- mojibake ----------------------------------------------------------------

_CP1252_BYTES = [b for b in range(0x80, 0xA0) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)]
_CP1252_CHARS = "".join(bytes([b]).decode("cp1252") for b in _CP1252_BYTES)
_C1_CHARS = "".join(chr(b) for b in _CP1252_BYTES)


def mojibake_original(col: Column) -> Column:
    """The UTF-8 text that was once decoded as Windows-1252, or null.

    Windows-1252 is reached through Latin-1: the 27 characters that differ are
    mapped to the code points of their byte values first.
    """
    encodable = ~col.rlike(r"[^\x00-\x7F\xA0-\xFF" + _CP1252_CHARS + "]")
    latin = F.translate(F.when(has_non_ascii(col) & encodable, col), _CP1252_CHARS, _C1_CHARS)
    decoded = F.try_validate_utf8(F.encode(latin, "ISO-8859-1").cast("string"))
    return F.when(decoded != col, decoded)


def repair_mojibake(col: Column) -> Column:
    return F.coalesce(mojibake_original(col), col)


def detect_mojibake(col: Column) -> Column:
    """The repaired text when a lead character is present and the round trip works."""
    return mojibake_original(F.when(col.rlike("[" + "".join(K.MOJIBAKE_LEADS) + "]"), col))


# --- summaries and descriptions ----------------------------------------------

def summary(col: Column, limit: int = 400) -> Column:
    """Collapsed ASCII text cut on a word boundary near ``limit`` characters."""
    text = collapse_space(ascii_ingest(F.coalesce(col, F.lit(""))))
    head = F.left(text, F.lit(limit))
    last_space = F.lit(limit) - F.instr(F.reverse(head), " ")
    cut = F.when((F.instr(F.reverse(head), " ") > 0) & (last_space > limit * 0.6),
                 F.left(head, last_space)).otherwise(head)
    return F.when(F.length(text) <= limit, text).otherwise(
        F.concat(F.rtrim(cut, F.lit(" ,;:.-")), F.lit("...")))


def description(abstract: Column, text: Column, title: Column, *, unknown: str,
                ascii_only: bool = False) -> Column:
    """Abstract, else first paragraph; 20 to 1,000 characters."""
    body = F.when(~empty(abstract), abstract).otherwise(
        F.split(F.coalesce(text, F.lit("")), "\n\n", 2)[0])
    body = strip(body)
    if ascii_only:
        body = ascii_mask(body)
    capped = F.when(F.length(body) > 1000,
                    F.concat(F.left(body, F.lit(997)), F.lit("..."))).otherwise(body)
    return F.when(F.length(capped) < 20,
                  F.concat(F.lit("Research publication: "), F.coalesce(title, F.lit(unknown)))
                  ).otherwise(capped)


# --- slugs -------------------------------------------------------------------

def event_slug(source: Column, record_id: Column) -> Column:
    raw = F.lower(F.concat(F.coalesce(source, F.lit("unknown")), F.lit("_"),
                           F.left(F.coalesce(record_id, F.lit("")), F.lit(16))))
    return F.left(F.btrim(F.regexp_replace(raw, "[^a-z0-9]+", "_"), F.lit("_")), F.lit(100))


def _symbol_slug(col: Column, symbols: Iterable[tuple[str, str]]) -> Column:
    out = col
    for symbol, word in symbols:
        out = F.replace(out, F.lit(symbol), F.lit(word))
    return F.btrim(F.regexp_replace(out, "[^a-z0-9]+", "_"), F.lit("_"))


def model_slug(name: Column) -> Column:
    slug = _symbol_slug(F.lower(ascii_ingest(name)),
                        (("++", "_plusplus"), ("+", "_plus"), ("#", "_sharp")))
    return F.when(F.length(slug) == 0, F.lit("unnamed")).otherwise(slug)


def lab_slug(name: Column) -> Column:
    return _symbol_slug(strip(F.lower(name)),
                        (("+", "_plus"), ("&", "_and_"), (".", "_dot_")))


# --- tokens ------------------------------------------------------------------

def tag_words(col: Column) -> Column:
    """Words of the domain tagger, short ones and stop words included."""
    return F.regexp_extract_all(F.lower(F.coalesce(col, F.lit(""))),
                                F.lit(r"[a-z][a-z0-9\-]+"), F.lit(0))


def tag_tokens(col: Column) -> Column:
    """Tokens of the domain tagger, repeats kept."""
    words = tag_words(col)
    stop = F.array(*[F.lit(w) for w in K.TAG_STOPWORDS])
    return F.filter(words, lambda w: (F.length(w) >= K.TAG_MIN_TOKEN_LENGTH)
                    & ~F.array_contains(stop, w))


def title_tokens(col: Column) -> Column:
    """The token set of a title."""
    words = F.regexp_extract_all(F.lower(F.coalesce(col, F.lit(""))),
                                 F.lit(r"[a-z0-9]+"), F.lit(0))
    stop = F.array(*[F.lit(w) for w in K.TITLE_STOPWORDS])
    return F.array_except(F.filter(words, lambda w: F.length(w) > 2), stop)


def cells(items: Column) -> Column:
    """Spreadsheet cells: ASCII, collapsed, empty to null."""
    return F.transform(ascii_ingest_items(items),
                       lambda s: F.nullif(collapse_space(s), F.lit("")))


def privacy_phrase(title: Column) -> Column:
    """The over-inclusive privacy screen on a title; a flag, never a deletion."""
    pattern = r"(?iU)\b(?:" + "|".join(K.PRIVACY_PHRASES) + r")\b"
    return F.coalesce(title, F.lit("")).rlike(pattern)


def evidence_text(col: Column) -> Column:
    """Lower case, dashes unified, punctuation to spaces, spaces collapsed."""
    low = F.translate(F.lower(col), "–—", "--")
    return F.regexp_replace(F.regexp_replace(low, r"[,;:()\[\]{}\"'`]", " "),
                            PY_SPACE_PATTERN, " ")
