"""Text, code and date expressions.  Every function takes and returns Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from zonalis.functions import fixed_values as V


def literal_map(pairs: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])


def label_by_upper(c: Column, steps: list[tuple[float, str]]) -> Column:
    """Label of the first step whose upper bound is not exceeded; the last is open."""
    out = F.when(c <= steps[0][0], steps[0][1])
    for bound, label in steps[1:-1]:
        out = out.when(c <= bound, label)
    return F.when(c.isNull(), None).otherwise(out.otherwise(steps[-1][1]))


def label_by_lower(c: Column, steps: list[tuple[float, str]], default: str) -> Column:
    """Label of the first step whose lower bound is reached."""
    out = F.when(c >= steps[0][0], steps[0][1])
    for bound, label in steps[1:]:
        out = out.when(c >= bound, label)
    return F.when(c.isNull(), None).otherwise(out.otherwise(default))


def clean_text(c: Column) -> Column:
    """Line breaks to spaces, double quotes to single, outer blanks off."""
    return F.trim(F.translate(c, "\r\n\"", "  '"))


def standard_age_group(c: Column) -> Column:
    """Band named in the text, matched on whole numbers; otherwise the lower-cased text."""
    text = F.lower(F.trim(c))
    out = F.when(c.isNull() | (text == ""), "all_ages")
    for band in V.AGE_BANDS:
        pattern = r"(^|\D)" + band.replace("+", r"\+") + (r"" if band.endswith("+") else r"(\D|$)")
        out = out.when(text.rlike(pattern), band)
    return out.when(text.contains("all ages"), "all_ages").otherwise(text)


def standard_sex(c: Column) -> Column:
    text = F.lower(F.trim(c))
    return (
        F.when(text.isin("m", "male", "males"), "Male")
        .when(text.isin("f", "female", "females"), "Female")
        .otherwise("Persons")
    )


def parent_code(code: Column, level: str) -> Column:
    """Prefix of the code at a higher level; null unless the code is a longer level's."""
    digits = V.CODE_DIGITS[level]
    longer = [n for n in V.CODE_DIGITS.values() if n > digits]
    return F.when(F.length(code).isin(longer), F.substring(code, 1, digits))


def valid_code(code: Column, level: str) -> Column:
    """Digits of the level, and a leading digit that is a state."""
    ok = code.rlike(rf"^\d{{{V.CODE_DIGITS[level]}}}$")
    return F.coalesce(ok & F.substring(code, 1, 1).isin(*V.STATES), F.lit(False))


def contained(child: Column, child_level: str, parent: Column, parent_level: str) -> Column:
    ok = (
        (F.length(child) == V.CODE_DIGITS[child_level])
        & (F.length(parent) == V.CODE_DIGITS[parent_level])
        & child.startswith(parent)
    )
    if V.CODE_DIGITS[child_level] <= V.CODE_DIGITS[parent_level]:
        return F.lit(False)
    return F.coalesce(ok, F.lit(False))


def state_of_code(code: Column) -> Column:
    return F.coalesce(F.try_element_at(literal_map(V.STATES), F.substring(code, 1, 1)), F.lit("OT"))


def level_of_length(n: Column) -> Column:
    return F.when(n == 6, "SA3").when(n == 3, "SA4").otherwise("SA2")


def padded_postcode(c: Column) -> Column:
    text = c.cast("string")
    return F.when(F.length(text) < 4, F.lpad(text, 4, "0")).otherwise(text)


def postcode_state(c: Column) -> Column:
    """State whose range holds the postcode; null for bad or unknown ones."""
    text = padded_postcode(c)
    n = F.when(text.rlike(r"^\d{4}$"), text.cast("int"))
    out = None
    for state, ranges in V.POSTCODES.items():
        inside = F.lit(False)
        for lo, hi in ranges:
            inside = inside | n.between(lo, hi)
        out = F.when(inside, state) if out is None else out.when(inside, state)
    return out


def postcode_problem(c: Column, expected_state: Column | None = None) -> Column:
    state = postcode_state(c)
    out = (
        F.when(~F.coalesce(padded_postcode(c).rlike(r"^\d{4}$"), F.lit(False)), "invalid_format")
        .when(state.isNull(), "unknown_postcode")
    )
    return out if expected_state is None else out.when(state != expected_state, "state_mismatch")


def time_zone(state: Column) -> Column:
    return F.coalesce(F.try_element_at(literal_map(V.TIME_ZONES), state), F.lit(V.DEFAULT_TIME_ZONE))


def decimal_places(c: Column) -> Column:
    """Digits after the point of the plain decimal form."""
    digits = F.regexp_extract(F.rtrim(F.format_string("%.12f", c), F.lit("0")), r"\.(\d*)$", 1)
    return F.greatest(F.length(digits), F.lit(1))


def valid_icd10(c: Column) -> Column:
    return F.coalesce(c.rlike(r"^[A-Z]\d{2}(\.\d{1,2})?$"), F.lit(False))


def icd10_chapter(c: Column) -> Column:
    out = None
    for pattern, label in V.ICD_CHAPTERS:
        hit = c.rlike("^" + pattern)
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return F.when(c.isNull(), None).otherwise(out.otherwise("Other causes"))


def age_band_5(age: Column) -> Column:
    low = (F.floor(age / 5) * 5).cast("int")
    return (
        F.when(age < 1, "0").when(age < 5, "1-4").when(age >= 85, "85+")
        .otherwise(F.concat(low.cast("string"), F.lit("-"), (low + 4).cast("string")))
    )


def urbanisation_by_name(name: Column) -> Column:
    text = F.lower(name)
    return (
        F.when(text.rlike("city|urban|metropolitan"), "major_urban")
        .when(text.contains("town"), "other_urban")
        .when(text.rlike("rural|farming|agricultural"), "rural_balance")
        .otherwise("other_urban")
    )


def remoteness_by_state(state: Column) -> Column:
    return (
        F.when(state.isin("1", "NSW", "2", "VIC"), "Major Cities of Australia")
        .when(state.isin("7", "NT", "5", "WA"), "Very Remote Australia")
        .otherwise("Inner Regional Australia")
    )


def indicator_code(prefix: str, name: Column) -> Column:
    return F.concat(F.lit(prefix + "_"), F.upper(F.replace(name, F.lit(" "), F.lit("_"))))


def parse_date(c: Column) -> Column:
    return F.coalesce(F.try_to_date(c, "yyyy-MM-dd"), F.try_to_date(c, "dd/MM/yyyy"))


def age_days(c: Column, as_of: Column) -> Column:
    return F.datediff(as_of, c)


def iso_timestamp(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")


def small_cell(count: Column, minimum: int = 5) -> tuple[Column, Column, Column]:
    """(value or null, suppressed flag, display text) of a count under privacy rules."""
    hide = F.coalesce(count < minimum, F.lit(False))
    return (
        F.when(~hide, count),
        hide,
        F.when(hide, f"<{minimum}").otherwise(count.cast("string")),
    )


def normal_code_type(c: Column) -> Column:
    text = F.lower(F.trim(c))
    return F.coalesce(F.try_element_at(literal_map(V.CODE_TYPE_ALIASES), text), text)
