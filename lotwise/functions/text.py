"""Text functions, Column -> Column.  They run inside generated JVM code and work
on batch and streaming frames alike."""

import sys
import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, functions as F
from pyspark.sql.types import StringType

from lotwise import fixed_values as fx

NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


# --------------------------------------------------------------- basics
def strip(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def squeeze(c: Column) -> Column:
    """Runs of spaces become one; outer white space goes."""
    return strip(F.regexp_replace(c, " +", " "))


def first_match(c: Column, pattern: str, group: int = 1) -> Column:
    """Regex group, null (not empty) when nothing matches."""
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))


def to_number(c: Column) -> Column:
    """Double when the whole text is a plain number, else null; never raises."""
    return F.when(c.rlike(NUMBER), F.trim(c).try_cast("double"))


def contains_any(c: Column, words: list[str]) -> Column:
    lowered = F.lower(c)
    hit = F.lit(False)
    for word in words:
        hit = hit | F.contains(lowered, F.lit(word))
    return F.coalesce(hit, F.lit(False))


# --------------------------------------------------------------- attributes
def turbo_flag(engine: Column, version: Column) -> Column:
    text = F.concat_ws(" ", F.coalesce(engine, F.lit("nan")), F.coalesce(version, F.lit("nan")))
    return text.rlike(fx.TURBO_PATTERN).cast("int")


def power_text(text: Column) -> Column:
    return first_match(text, fx.POWER_PATTERN)


def horse_power(*texts: Column, found: Column | None = None) -> Column:
    """The first number of horse powers; ``found`` is what a text before them holds, if that is known."""
    known = [] if found is None else [found]
    return F.coalesce(*known, *[power_text(t) for t in texts]).try_cast("bigint")


def traction(version: Column) -> Column:
    return (F.when(version.rlike(fx.FOUR_WHEEL_PATTERN), "4x4")
            .when(version.rlike(fx.TWO_WHEEL_PATTERN), "4x2"))


def engine_size(text: Column) -> Column:
    found = F.coalesce(first_match(text, fx.ENGINE_DOT_PATTERN),
                       first_match(text, fx.ENGINE_COMMA_PATTERN))
    return F.translate(found, ",", ".").try_cast("double")


def engine_repair(engine: Column, version: Column, size: Column | None = None) -> Column:
    """A null engine stays null; only a text that is no number falls back.  ``size`` is the version's, if that is known."""
    return F.when(engine.isNotNull(),
                  F.coalesce(to_number(engine), engine_size(engine), engine_size(version) if size is None else size))


def engine_leading(engine: Column) -> Column:
    """Looser form: a digit, a dot and a digit at a word start."""
    return first_match(engine, r"(?U)\b(\d\.\d)").try_cast("double")


def engine_repair_prefix(engine: Column, version: Column) -> Column:
    """Form that keeps the engine text and reads the version's first characters only."""
    head = first_match(version, r"^(\d\.\d)")
    return F.when(engine.isNull() | to_number(engine).isNotNull(), engine).otherwise(
        F.coalesce(head, engine))


def is_numeric_text(c: Column) -> Column:
    """Digits with at most one dot."""
    return F.coalesce(c.rlike(r"^\d*\.?\d*$") & c.rlike(r"\d"), F.lit(False))


# --------------------------------------------------------------- version text
def drop_engine_size(c: Column) -> Column:
    for pattern in (fx.ENGINE_SIZE_TOKEN, fx.TURBO_SIZE_TOKEN, fx.TURBO_WORD_TOKEN):
        c = F.regexp_replace(c, pattern, " ")
    return squeeze(c)


def drop_gearbox(c: Column) -> Column:
    for pattern in (fx.GEARBOX_COUNT_TOKEN, fx.GEARBOX_WORD_TOKEN):
        c = F.regexp_replace(c, pattern, "")
    return squeeze(c)


def drop_power(c: Column) -> Column:
    return strip(F.replace(F.regexp_replace(c, fx.POWER_TOKEN, ""), F.lit("  "), F.lit(" ")))


def drop_traction(c: Column) -> Column:
    for pattern in fx.TRACTION_TOKENS:
        c = F.regexp_replace(c, pattern, "")
    return squeeze(c)


def drop_values(c: Column, *values: Column) -> Column:
    """Remove a row's own values, one after the other, where they stand as whole words.

    The fold keeps ``c`` in the expression once.  A value that does not occur
    gets the constant never-matching pattern, so no regex is compiled for it.
    """
    def drop(text: Column, value: Column) -> Column:
        quoted = F.replace(value, F.lit("\\E"), F.lit("\\E\\\\E\\Q"))
        pattern = F.concat(F.lit("(?U)\\b\\Q"), quoted, F.lit("\\E\\b"))
        usable = value.isNotNull() & ~value.isin("", "nan") & F.contains(text, value)
        return F.regexp_replace(text, F.when(usable, pattern).otherwise("(?!)"), F.lit(""))

    return F.aggregate(F.array(*[F.lower(v) for v in values]), c, drop)


def drop_row_words(c: Column, fuel: Column, brand: Column, model: Column, body: Column) -> Column:
    c = drop_values(F.lower(c), fuel, brand, model, body)
    c = F.regexp_replace(c, fx.FUEL_WORDS_TOKEN, "")
    c = F.regexp_replace(c, fx.BODY_WORDS_TOKEN, "")
    return strip(F.regexp_replace(c, r"(?U)\s+", " "))


def bare_version(version: Column) -> Column:
    """The version without engine, gearbox, power and traction."""
    return drop_traction(drop_power(drop_gearbox(drop_engine_size(version))))


def clean_version(version: Column, fuel: Column, brand: Column, model: Column, body: Column) -> Column:
    return drop_row_words(bare_version(version), fuel, brand, model, body)


def version_from_title(title: Column, fuel: Column, brand: Column, model: Column, body: Column) -> Column:
    usable = title.isNotNull() & ~F.lower(title).isin("", "nan", "none")
    bare = drop_values(F.lower(title), brand, model)
    bare = strip(F.regexp_replace(bare, r"(?U)\s+", " "))
    return F.when(usable, F.nullif(clean_version(bare, fuel, brand, model, body), F.lit("")))


# --------------------------------------------------------------- kilometres
def kilometres(c: Column) -> Column:
    with_unit = to_number(F.replace(F.replace(c, F.lit(" km"), F.lit("")), F.lit("."), F.lit("")))
    digits = first_match(F.replace(c, F.lit("."), F.lit("")), r"(?U)(\d+)").try_cast("double")
    return F.coalesce(to_number(c), F.when(F.endswith(c, F.lit(" km")), with_unit).otherwise(digits))


def kilometres_plain(c: Column) -> Column:
    """Form that takes commas as thousands marks and dots as decimals."""
    bare = F.replace(F.replace(F.lower(c), F.lit("km"), F.lit("")), F.lit(","), F.lit(""))
    return to_number(strip(bare))


def kilometres_unit_only(c: Column) -> Column:
    """Form that only drops the unit."""
    return to_number(F.replace(F.replace(c, F.lit(" km"), F.lit("")), F.lit("km"), F.lit("")))


# --------------------------------------------------------------- descriptions
def down_payment_flag(km: Column, description: Column) -> Column:
    text = F.lower(description)
    strong = F.lit(False)
    for pattern in fx.DOWN_PAYMENT_STRONG:
        strong = strong | text.rlike(pattern)
    weak = F.contains(text, F.lit(fx.DOWN_PAYMENT_WORD)) & contains_any(description, fx.DOWN_PAYMENT_WEAK)
    return F.when((km <= 0) & (strong | weak), 1).otherwise(0)


def damage_words(description: Column) -> Column:
    return contains_any(description, fx.DAMAGE_WORDS)


def preview(c: Column, length: int = 200) -> Column:
    return F.substring(c, 1, length)


def first_integer(c: Column) -> Column:
    return F.coalesce(first_match(c, r"(\d+)").try_cast("bigint"), F.lit(0).cast("bigint"))


# --------------------------------------------------------------- letters
@lru_cache(maxsize=None)
def _letter_rules(ascii_only: bool) -> tuple[str, str, str, tuple[tuple[str, str], ...]]:
    """Translation rules worked out from Unicode decomposition.

    Returns one-to-one letters (from, to), letters to delete, and one-to-many
    replacements.  One-to-one and deleted letters are complete for all of
    Unicode; one-to-many ones cover the Latin blocks.
    """
    source, target, deleted, longer = [], [], [], []
    for point in range(0x80, sys.maxunicode + 1):
        letter = chr(point)
        if unicodedata.category(letter) in ("Cn", "Cs", "Co"):
            continue
        if letter != letter.lower():
            continue
        parts = unicodedata.normalize("NFKD", letter)
        if ascii_only:
            folded = parts.encode("ascii", "ignore").decode()
        else:
            folded = "".join(p for p in parts if not unicodedata.combining(p))
            if folded == letter:
                continue
        if len(folded) == 1:
            source.append(letter)
            target.append(folded)
        elif folded == "":
            if not ascii_only:
                deleted.append(letter)
        elif point < 0x250:
            longer.append((letter, folded))
    return "".join(source), "".join(target), "".join(deleted), tuple(longer)


def _fold(c: Column, ascii_only: bool) -> Column:
    source, target, deleted, longer = _letter_rules(ascii_only)
    for letters, folded in longer:
        c = F.replace(c, F.lit(letters), F.lit(folded))
    return F.translate(c, source + deleted, target)


def fold_letters(c: Column) -> Column:
    """Lower case, outer space and accents removed; other letters stay."""
    lowered = strip(F.lower(c))
    return F.when(lowered.rlike(r"[^\x00-\x7F]"), _fold(lowered, False)).otherwise(lowered)


def ascii_words(c: Column) -> Column:
    """Lower case ASCII letters, digits and spaces; runs of anything else are one space."""
    lowered = F.lower(c)
    folded = F.when(lowered.rlike(r"[^\x00-\x7F]"),
                    F.regexp_replace(_fold(lowered, True), r"[^\x00-\x7F]", "")).otherwise(lowered)
    return F.trim(F.regexp_replace(folded, "[^a-z0-9 ]+", " "))


def ascii_words_squeezed(c: Column) -> Column:
    return F.regexp_replace(ascii_words(c), " +", " ")


@F.pandas_udf(StringType())
def ascii_words_unicode(texts: pd.Series) -> pd.Series:
    """Same as ``ascii_words`` with every one-to-many letter of Unicode; for distinct values."""
    folded = texts.str.lower().str.normalize("NFKD").str.encode("ascii", "ignore").str.decode("ascii")
    return folded.str.replace("[^a-z0-9 ]+", " ", regex=True).str.strip()


def repair_letters(c: Column) -> Column:
    """Undo escapes and double encoding.

    The text is viewed byte by byte, JSON escapes are resolved and the known
    letter pairs put back.  A text whose escapes cannot be read only gets the
    letter pairs.
    """
    def pairs(col: Column) -> Column:
        for wrong, right in fx.DOUBLE_ENCODED.items():
            col = F.replace(col, F.lit(wrong), F.lit(right))
        return col

    viewed = F.decode(F.encode(c, "UTF-8"), "ISO-8859-1")
    quoted = F.concat(F.lit('{"v":"'), F.replace(viewed, F.lit('"'), F.lit('\\"')), F.lit('"}'))
    resolved = (F.when(~F.contains(c, F.lit("\\")), viewed)
                .when(~F.contains(c, F.lit('"')), F.get_json_object(quoted, "$.v")))
    return F.coalesce(pairs(resolved), pairs(c))


# --------------------------------------------------------------- colours
def colour_text(c: Column) -> Column:
    return F.lower(strip(c))
