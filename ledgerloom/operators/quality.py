"""Column profiles, schema drift and header or null clean-up."""

from __future__ import annotations

from functools import reduce
from itertools import zip_longest

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Text lengths from which the next wider text type is used, widest first.
TEXT_WIDTHS = ((256, "TEXT"), (100, "VARCHAR(255)"), (50, "VARCHAR(100)"), (25, "VARCHAR(50)"), (15, "VARCHAR(25)"), (10, "VARCHAR(15)"), (5, "VARCHAR(10)"))
NARROWEST_TEXT = "VARCHAR(5)"
BIGINT_CHARS = 10
#: Digits and sign of the longest whole number a BIGINT, and of the longest number a NUMERIC, can hold for sure.
BIGINT_LAST, NUMERIC_LAST = 19, 38
#: How the measures of a column state merge.
SUMS, MAXIMA = ["nulls", "texts", "fractions", "nonzero", "times"], ["chars", "whole", "depth", "printed"]

#: What a cell of a column holds, besides whether it is null.
CELL = {"text": "string", "whole": "int", "digits": "int", "nonzero": "boolean", "time": "boolean"}

NUMBER_TEXT = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def _name(column: str) -> Column:
    return F.col(f"`{column}`")


def _number_steps(field: T.StructField, i: int) -> list[dict[str, Column]]:
    """Columns that tell of a value the number it is (``_number``), whether no decimal holds it (``_wide``), and how it prints: digits (and sign)
    before the point (``_whole``) and after it without trailing zeros (``_digits``). Each step reads the one before, so each text is parsed once.

    Wide numbers are measured on their text, by its digits, or by its magnitude where it has an exponent.
    """
    def made(name: str) -> Column:
        return F.col(f"{name}_{i}")

    value, kind = _name(field.name), field.dataType
    text, number, wide = value.cast("string"), made("_number"), made("_wide")
    if isinstance(kind, T.StringType):
        # Most texts are no numbers, and their first character tells: blanks, signs, the point and digits come before the colon.
        like, large = made("_like"), F.abs(F.trim(text).try_cast("double")) < float("inf")
        steps = [{"_like": F.when(F.ascii(text) < ord(":"), text.rlike(NUMBER_TEXT)).otherwise(False)},
                 {"_number": F.when(like, F.trim(text).try_cast("decimal(38,10)"))},
                 {"_wide": F.when(like & number.isNull(), F.coalesce(large, F.lit(False))).otherwise(False)}]
    elif isinstance(kind, T.DecimalType):
        steps = [{"_number": value, "_wide": F.lit(False)}]
    elif isinstance(kind, (T.DoubleType, T.FloatType)):
        # NaN stands for no value.
        known = made("_known")
        steps = [{"_known": F.when(~F.isnan(value) & (F.abs(value) < float("inf")), value)}, {"_number": known.try_cast("decimal(38,6)")},
                 {"_wide": known.isNotNull() & number.isNull()}]
    else:
        return []
    plain, shown = F.trim(text), made("_shown")
    exponent = plain.rlike("[eE]")
    sign = F.when(plain.startswith("-"), 1).otherwise(0)
    magnitude = F.floor(F.log10(F.abs(plain.try_cast("double")))).cast("int") + 1
    wide_whole = sign + F.when(exponent, magnitude).otherwise(F.octet_length(F.regexp_extract(plain, r"^[+-]?0*([0-9]*)", 1)))
    wide_digits = F.when(exponent, 0).otherwise(F.octet_length(F.rtrim(F.regexp_extract(plain, r"\.([0-9]*)$", 1), F.lit("0"))))
    # a decimal may print with an exponent, which has no digits after the point to count
    digits = F.when(shown.contains(".") & ~shown.contains("E"), F.octet_length(F.rtrim(F.substring_index(shown, ".", -1), F.lit("0")))).otherwise(0)
    steps += [{"_shown": number.cast("string")}, {
        "_whole": F.when(wide, wide_whole).otherwise(F.octet_length(F.substring_index(shown, ".", 1))), "_digits": F.when(wide, wide_digits).otherwise(digits)}]
    return [{f"{name}_{i}": column for name, column in step.items()} for step in steps]


def _cell(field: T.StructField, i: int) -> Column:
    """What one value adds to the profile of its column; texts are measured afterwards, all columns by the same few expressions."""
    value, kind = _name(field.name), field.dataType
    cell: dict[str, Column] = {"null": value.isNull(), **{name: F.lit(None).cast(t) for name, t in CELL.items()}}
    if isinstance(kind, T.StringType):
        cell["text"] = value
    elif isinstance(kind, T.IntegralType):
        cell |= {"whole": F.char_length(value.cast("string")), "nonzero": value != 0}
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        cell["time"] = value != F.date_trunc("day", value).cast(kind)
    elif _number_steps(field, i):
        cell |= {"whole": F.col(f"_whole_{i}"), "digits": F.col(f"_digits_{i}"), "nonzero": F.col(f"_wide_{i}") | (F.col(f"_number_{i}") != 0)}
        if not isinstance(kind, T.DecimalType):
            cell["null"] = value.isNull() | F.isnan(value)
    return F.struct(F.lit(i).alias("_column"), *[c.alias(f"_{name}") for name, c in cell.items()])


def _measures() -> dict[str, Column]:
    """The measures of a column from its cells, each a sum or a maximum, so that states merge."""
    text, is_null = F.col("_text"), F.col("_null")
    number, wide = F.col("_number_text"), F.col("_wide_text")

    def of(name: str, from_text: Column) -> Column:
        return F.when(text.isNotNull(), from_text).otherwise(F.col(f"_{name}"))

    whole, digits = of("whole", F.col("_whole_text")), of("digits", F.col("_digits_text"))
    depth = F.greatest(digits, F.lit(1))
    nan = (F.octet_length(text) == 3) & F.lower(text).isin("nan")
    return {
        "nulls": F.count_if(is_null), "texts": F.count_if(text.isNotNull() & ~nan & number.isNull() & ~wide), "fractions": F.count_if(digits > 0),
        "nonzero": F.count_if(of("nonzero", wide | (number != 0))), "times": F.count_if("_time"),
        # An unknown value prints as "None", four characters.
        "chars": F.max(F.when(is_null, F.lit(4)).otherwise(F.char_length(text))),
        "whole": F.max(whole), "depth": F.max(depth), "printed": F.max(whole + 1 + depth),
    }


def _applies(kind: T.DataType) -> set[str]:
    """The measures a column of this type has; the others are null."""
    numbers = {"nulls", "fractions", "nonzero", "whole", "depth", "printed"}
    if isinstance(kind, T.StringType):
        return numbers | {"texts", "chars"}
    if isinstance(kind, (T.DecimalType, T.DoubleType, T.FloatType)):
        return numbers
    if isinstance(kind, T.IntegralType):
        return {"nulls", "fractions", "nonzero", "whole"}
    return {"nulls", "times"} if isinstance(kind, (T.TimestampType, T.TimestampNTZType)) else {"nulls"}


def _family(kind: T.DataType) -> str:
    if isinstance(kind, T.StringType):
        return "text"
    if isinstance(kind, T.BooleanType):
        return "bool"
    if isinstance(kind, T.DateType):
        return "date"
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return "time"
    return "number"


def _when(rules: list[tuple[Column, Column]], otherwise: Column) -> Column:
    return reduce(lambda rest, rule: F.when(rule[0], rule[1]).otherwise(rest), reversed(rules), otherwise)


def _text_type(chars: Column) -> Column:
    return _when([(chars >= n, F.lit(name)) for n, name in TEXT_WIDTHS], F.lit(NARROWEST_TEXT))


def _stepped(df: DataFrame, fields: list[tuple[object, T.StructField]]) -> DataFrame:
    for step in zip_longest(*[_number_steps(f, i) for i, f in fields], fillvalue={}):
        df = df.withColumns({name: column for part in step for name, column in part.items()})
    return df


def profile_state(df: DataFrame) -> DataFrame:
    """What the profile of ``df`` is made of, one row per column, from one aggregation; states of parts merge to that of the whole.

    A row unfolds into a cell per column, and cells are added up per column. One expression for all texts keeps the compiled
    code small; as aggregates side by side, a dozen columns came to a method too long for the JVM to compile.
    """
    fields = list(enumerate(df.schema.fields))
    parsed = _stepped(df, [(i, f) for i, f in fields if not isinstance(f.dataType, T.StringType)])
    cells = _stepped(parsed.select(F.inline(F.array(*[_cell(f, i) for i, f in fields]))), [("text", T.StructField("_text", T.StringType()))])
    added = cells.groupBy("_column").agg(*[m.cast("bigint").alias(k) for k, m in _measures().items()])
    # one row also if there were no cells
    row = added.agg(F.map_from_entries(F.collect_list(F.struct("_column", F.struct(*SUMS, *MAXIMA)))).alias("_measured"))

    def measure(i: int, kind: T.DataType, name: str) -> Column:
        found = F.col("_measured")[i][name]
        known = F.coalesce(found, F.lit(0).cast("bigint")) if name in SUMS else found
        return (known if name in _applies(kind) else F.lit(None).cast("bigint")).alias(name)

    rows = F.array(*[
        F.struct(F.lit(i + 1).alias("position"), F.lit(f.name).alias("column_name"), F.lit(_family(f.dataType)).alias("family"),
                 *[measure(i, f.dataType, name) for name in SUMS + MAXIMA])
        for i, f in fields
    ])
    return row.select(F.inline(rows))


def merge_states(states: DataFrame) -> DataFrame:
    """States of parts (files, days, deliveries) of a table as the state of all of it; new parts need no scan of the old ones.

    A column whose parts have different families fails the merge with its name.
    """
    families = F.concat(F.lit("a column of different types: "), F.col("column_name"))
    merged = states.groupBy("column_name").agg(
        F.min("position").alias("position"), F.min("family").alias("family"), F.max("family").alias("_other"),
        *[F.sum(m).alias(m) for m in SUMS], *[F.max(m).alias(m) for m in MAXIMA])
    family = F.when(F.col("family") == F.col("_other"), F.col("family")).otherwise(F.raise_error(families))
    return merged.select("position", "column_name", family.alias("family"), *SUMS, *MAXIMA)


def profile_column_types(df: DataFrame) -> DataFrame:
    """One row per column with the type a table should give it, from one aggregation over the data."""
    return profile_types(profile_state(df))


def profile_types(profile: DataFrame) -> DataFrame:
    """The type each column of a state should have.

    Texts that are all numbers become numbers. Numbers without a fraction become INTEGER, or BIGINT from ten characters
    on, or NUMERIC where a BIGINT is too short; others NUMERIC by the longest number as it prints and by depth. What no
    NUMERIC holds is DOUBLE, or stays text. Timestamps without a time part are dates.
    """
    numeric_text = (F.col("family") == "text") & (F.col("texts") == 0)
    is_number = (F.col("family") == "number") | numeric_text
    whole = F.greatest(F.col("whole"), F.lit(1))
    fractional = is_number & (F.col("fractions") > 0)
    length = F.when(fractional, F.col("printed")).when(is_number, whole).otherwise(F.col("chars"))
    scale = F.when(F.col("depth") <= 2, F.lit("2")).otherwise(F.lit("4"))
    precision = F.when(length <= 10, F.lit("12")).when(length <= 20, F.lit("20")).otherwise(F.lit("38"))
    target = _when(
        [
            (numeric_text & (length > NUMERIC_LAST), _text_type(F.col("chars"))), (is_number & (length > NUMERIC_LAST), F.lit("DOUBLE")),
            (is_number & ~fractional & (length > BIGINT_LAST), F.lit("NUMERIC(38,2)")),
            (fractional, F.concat(F.lit("NUMERIC("), precision, F.lit(","), scale, F.lit(")"))),
            (is_number & (length >= BIGINT_CHARS), F.lit("BIGINT")), (is_number, F.lit("INTEGER")),
            (F.col("family") == "bool", F.lit("BOOLEAN")), (F.col("family") == "date", F.lit("DATE")),
            ((F.col("family") == "time") & (F.col("times") > 0), F.lit("DATETIME")), (F.col("family") == "time", F.lit("DATE")),
        ],
        _text_type(F.coalesce("chars", F.lit(0))),
    )
    return profile.select(
        "position", "column_name", target.alias("target_type"), F.coalesce(length, F.lit(0)).cast("bigint").alias("max_length"),
        F.col("nulls").alias("null_count"), (is_number & (F.coalesce("nonzero", F.lit(0)) == 0)).alias("zero_or_null"),
    )


def ddl_type(target: Column) -> Column:
    """Type name used when a column is added to a stored table."""
    return (
        F.when(target.startswith("NUMERIC"), F.replace(target, F.lit("NUMERIC"), F.lit("FLOAT")))
        .when(target == "INTEGER", F.lit("INT")).when(target == "DATETIME", F.lit("DATE")).when(target == "BOOLEAN", F.lit("BOOL"))
        .otherwise(target)
    )


def schema_missing_columns(incoming: DataFrame, stored: DataFrame) -> DataFrame:
    """Columns of the incoming profile that the stored one lacks (names without case), with the type to add."""
    names = stored.select(F.lower("column_name").alias("_name"))
    missing = incoming.join(F.broadcast(names), F.lower("column_name") == F.col("_name"), "left_anti")
    return missing.select("column_name", ddl_type(F.col("target_type")).alias("ddl_type"))


def schema_widening_plan(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """What to do with each stored column (column_name, stored_type) given the incoming profile.

    ``keep`` when equal or when the stored type already holds the new values, ``widen`` for longer
    text, ``change`` otherwise unless the incoming column holds nothing but zeros and nulls.
    """
    joined = stored.select("column_name", F.upper("stored_type").alias("stored_type")).join(
        F.broadcast(incoming.select(F.col("column_name").alias("_name"), "target_type", "zero_or_null")),
        F.col("column_name") == F.col("_name"),
    )
    old, new = F.col("stored_type"), F.col("target_type")
    text_old, text_new = old.startswith("VARCHAR"), new.startswith("VARCHAR")
    float_old = old.startswith("FLOAT")
    number_new = new.startswith("NUMERIC") | new.startswith("DECIMAL") | new.startswith("FLOAT") | new.isin("INTEGER", "BIGINT")
    narrower = reduce(
        lambda a, b: a | b,
        [(old == f"{k}(20,{s})") & (new == f"{k}(12,{s})") for k in ("FLOAT", "DECIMAL", "NUMERIC") for s in (2, 4)],
    )
    held = (
        (old == new)
        | (old.isin("INT", "INT(11)") & (new == "INTEGER"))
        | ((old == "BIGINT(20)") & (new == "BIGINT"))
        | (old.isin("BIGINT", "BIGINT(20)") & (new == "INTEGER"))
        | (old.isin("DATE", "DATETIME") & text_new)
        | (float_old & (new == "INTEGER"))
        | ((old == "TINYINT(1)") & (new == "BOOLEAN"))
        | narrower
        | (text_old & (number_new | (new == "BOOLEAN")))
        | ((old == "DATE") & (new == "DATETIME"))
        | ((old == "TEXT") & (text_new | new.startswith("FLOAT")))
    )
    length = lambda c: F.regexp_extract(c, r"\(([0-9]+)\)", 1).try_cast("int")
    action = (
        F.when(held, F.lit("keep"))
        .when(text_old & text_new, F.when(length(new) > length(old), F.lit("widen")).otherwise(F.lit("keep")))
        .when(F.col("zero_or_null"), F.lit("keep"))
        .otherwise(F.lit("change"))
    )
    return joined.select(
        "column_name", "stored_type", "target_type", action.alias("action"),
        F.when(action == "keep", old).otherwise(new).alias("new_type"),
    )


def normalize_headers(df: DataFrame) -> DataFrame:
    """Header names in lower case with underscores."""
    return df.toDF(*[c.lower().replace(" ", "_") for c in df.columns])


def title_headers(df: DataFrame) -> DataFrame:
    """Header names as shown in a sheet."""
    return df.toDF(*[c.replace("_", " ").title() for c in df.columns])


def null_normalize(df: DataFrame, whole_numbers: list[str] | None = None) -> DataFrame:
    """Nulls become 0 in whole-number columns and "" in text, where "None" counts as null too."""
    whole = whole_numbers or [f.name for f in df.schema.fields if isinstance(f.dataType, T.IntegralType)]
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.fillna(0, whole).withColumns({
        c: F.when(_name(c).isNull() | (_name(c) == "None"), F.lit("")).otherwise(_name(c)) for c in text
    })
