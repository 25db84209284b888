"""Column builders for French numbers, dates and texts; each takes and returns a column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Months as they are written, without accents.
MONTHS = {"janvier": 1, "fevrier": 2, "mars": 3, "avril": 4, "mai": 5, "juin": 6, "juillet": 7, "aout": 8, "septembre": 9, "octobre": 10, "novembre": 11, "decembre": 12}
# Accented letters and their plain forms.
ACCENTED, PLAIN = "àâäáãåçéèêëíìîïñóòôöõúùûüýÿ", "aaaaaaceeeeiiiinooooouuuuyy"
#: Java's \s leaves out the spaces that do not break; French thousands stand apart by them.
GAPS = "[\\s\\u00a0\\u202f\\u2007]+"


def _number(text: Column) -> Column:
    """A double, or null where the text is no number; texts such as 'NaN' are none."""
    return F.when(text.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), text.try_cast("double"))


def clean_number(c: Column) -> Column:
    """'8 377', '28,97%', '31 372 MFCFA' as doubles; '', '-' and 'n/a' are null."""
    return _number(F.replace(F.regexp_replace(F.regexp_replace(c, GAPS, ""), "MFCFA|FCFA|%", ""), F.lit(","), F.lit(".")))


def clean_int(c: Column) -> Column:
    """The number without its fraction."""
    return clean_number(c).cast("long")


def clean_text(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def first_comma_number(c: Column) -> Column:
    """Like clean_number, but only the first comma is a point, so '1,2,3' is null."""
    bare = F.regexp_replace(F.regexp_replace(c, GAPS, ""), "%", "")
    return _number(F.regexp_replace(bare, "^([^,]*),", "$1."))


def digits(c: Column) -> Column:
    """The digits of the text as one whole number; null without any."""
    return F.nullif(F.regexp_replace(c, "[^0-9]", ""), F.lit("")).try_cast("long")


def spaces_normalised(c: Column) -> Column:
    return F.btrim(F.regexp_replace(F.coalesce(c, F.lit("")), GAPS, " "))


def slash_date(c: Column) -> Column:
    """'22/4/2026' as '2026-04-22'; other texts as they are, trimmed."""
    parts = F.split(F.btrim(F.coalesce(c, F.lit(""))), "/")
    iso = F.concat_ws("-", F.get(parts, F.lit(2)), F.lpad(F.get(parts, F.lit(1)), 2, "0"), F.lpad(F.get(parts, F.lit(0)), 2, "0"))
    return F.when(F.size(parts) == 3, iso).otherwise(F.btrim(F.coalesce(c, F.lit(""))))


def plain(c: Column) -> Column:
    """Lower case without accents, curly apostrophes straight, other letters beyond ASCII dropped."""
    return F.regexp_replace(F.translate(F.lower(F.translate(F.coalesce(c, F.lit("")), "’‘", "''")), ACCENTED, PLAIN), r"[^\x00-\x7F]", "")


def french_date(c: Column) -> Column:
    """'15 juin 2026' as a date; null where it is none."""
    text = F.btrim(F.lower(c))
    part = lambda k: F.regexp_extract(text, r"^(\d{1,2})\s+([a-zàâçéèêëîïôûü]+)\s+(\d{4})", k)
    months = F.create_map(*[F.lit(x) for kv in MONTHS.items() for x in kv])
    month = F.try_element_at(months, F.translate(part(2), ACCENTED, PLAIN))
    return F.try_to_date(F.concat_ws("-", part(3), F.lpad(month.cast("string"), 2, "0"), F.lpad(part(1), 2, "0")), "yyyy-MM-dd")


def is_iso(c: Column) -> Column:
    return F.coalesce(c.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.lit(False))


def exercice(value: Column, notice_url: Column, paid: Column) -> Column:
    """The year as text: as given (without '.0'), else from the notice's address, else the year before the payment."""
    given = F.regexp_replace(F.btrim(value.cast("string")), r"\.0$", "")
    given = F.when(~F.lower(given).isin("", "nan"), given)
    named = clean_text(F.regexp_extract(notice_url, r"(?i)exercice[_\-]?(\d{4})", 1))
    before = F.when(is_iso(paid), (F.substring(paid, 1, 4).try_cast("int") - 1).cast("string"))
    return F.coalesce(given, named, before, F.lit(""))


def country(ticker: Column) -> Column:
    return F.lower(F.substring_index(ticker, ".", -1))


def symbol_key(symbol: Column) -> Column:
    """As in file names; several symbols could share it, so go back by a join only."""
    return F.translate(symbol, ".-", "__")


def notice_path(ticker: Column, year: Column, url: Column) -> Column:
    name = F.regexp_replace(F.substring_index(F.substring_index(url, "?", 1), "/", -1), r"(?i)\.pdf$", "")
    return F.concat(ticker, F.lit("/"), year, F.lit("_"), name, F.lit(".pdf"))


def formatted(c: Column, decimals: int = 0, unit: str = "") -> Column:
    """'1 234,50' with narrow spaces that do not break, and a unit after it."""
    text = F.translate(F.format_number(F.when(F.isnan(c), 0).otherwise(F.coalesce(c, F.lit(0))), decimals), ",.", "\u202f,")
    return F.concat(text, F.lit(f" {unit}" if unit else ""))


def signed_percent(c: Column, decimals: int = 2) -> Column:
    return F.when(c.isNull() | F.isnan(c), F.lit("—")).otherwise(F.concat(F.when(c > 0, F.lit("+")).otherwise(F.lit("")), formatted(c, decimals), F.lit(" %")))


def half_up(c: Column, digits: int = 0) -> Column:
    """Rounds halves up, as scripts in browsers do."""
    scale = 10.0**digits
    return F.floor(c * scale + 0.5) / scale


def looked_up(c: Column, values: dict[str, str], default: str | Column) -> Column:
    """The value for the text without spaces around it and in any case; the default for others and for null."""
    known = F.create_map(*[F.lit(x) for k, v in values.items() for x in (k.lower().strip(), v)]) if values else F.create_map().cast("map<string,string>")
    return F.coalesce(F.try_element_at(known, F.lower(F.btrim(c))), F.lit(default) if isinstance(default, str) else default)
