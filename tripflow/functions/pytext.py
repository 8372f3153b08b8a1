"""Column -> text exactly as Python's ``str()`` prints the collected value.

The ride wire format is ``", ".join(str(v) for v in row)``; building it
with Spark expressions keeps the encoding on the executors. Differences
from Spark's own ``CAST(x AS STRING)`` handled here:

* null prints as ``None``;
* timestamps print without the fraction when it is zero, otherwise with
  six digits;
* doubles and floats follow Python's repr: ``nan``, ``inf``, fixed notation
  for 1e-4 <= |x| < 1e16 (Java switches to ``1.0E7`` style at 1e7 and
  1e-3), ``1e+16`` style outside it. Floats print as the double Python
  sees (``str(float32 -> double)``), which Spark's double cast gives.

The digits come from the JVM's ``Double.toString``. On Java 17 these are
the shortest round-trip digits (so the text equals Python's) for
1e-99 <= |x| < 1e16 and for 0; beyond that range Java may print one or
two digits more than tell the double from its neighbours. ``python_texts``
shortens those: of the numbers with fewer digits next to Java's, the nearest
that parses back to the same double is taken, with as few digits as
possible (above 9.2e18, where two such numbers are equally near to Java's
digits, the last digit may be one off Python's). It works in a few projections, so that no expression is built
twice; ``python_text`` is the one-expression form without that step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NONE_TOKEN = "None"


def _timestamp_text(c: Column) -> Column:
    return F.when(
        F.date_format(c, "SSSSSS") == F.lit("000000"), F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    ).otherwise(F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS"))


def _double_text(c: Column) -> Column:
    """Python repr of a double, from Java's shortest digits."""
    d = c.cast("double")
    java = d.cast("string")  # "123.5", "1.0E7", "1.234E-5", "NaN", "Infinity"
    mant = F.split_part(java, F.lit("E"), F.lit(1))
    exp = F.split_part(java, F.lit("E"), F.lit(2)).try_cast("int")
    neg = F.startswith(mant, F.lit("-"))
    sign = F.when(neg, F.lit("-")).otherwise(F.lit(""))
    unsigned = F.when(neg, F.substring(mant, 2, 64)).otherwise(mant)
    int_part = F.split_part(unsigned, F.lit("."), F.lit(1))
    frac = F.split_part(unsigned, F.lit("."), F.lit(2))
    # all significant digits, the point sitting after the first one
    digits = F.concat(int_part, F.when(frac == F.lit("0"), F.lit("")).otherwise(frac))
    ndig = F.length(digits)
    # Python fixed notation for a Java scientific value with 0 <= exp < 16
    whole = F.when(
        ndig <= exp + 1, F.concat(F.rpad(digits, exp + 1, "0"), F.lit(".0"))
    ).otherwise(
        F.concat(
            F.substring(digits, F.lit(1), exp + 1),
            F.lit("."),
            F.substring(digits, exp + 2, F.lit(64)),
        )
    )
    # Python fixed notation for exp == -4 (Java prints 1.0E-4 as scientific)
    tiny = F.concat(F.lit("0.000"), digits)
    # Python scientific: d[.ddd]e+XX
    sci_mant = F.when(F.length(digits) == 1, digits).otherwise(
        F.concat(F.substring(digits, F.lit(1), F.lit(1)), F.lit("."), F.substring(digits, F.lit(2), F.lit(64)))
    )
    sci = F.concat(
        sci_mant,
        F.lit("e"),
        F.when(exp < 0, F.lit("-")).otherwise(F.lit("+")),
        F.lpad(F.abs(exp).cast("string"), 2, "0"),
    )
    scientific = F.when((exp >= 0) & (exp < 16), whole).when(exp == -4, tiny).otherwise(sci)
    return (
        F.when(F.isnan(d), F.lit("nan"))
        .when(d == F.lit(float("inf")), F.lit("inf"))
        .when(d == F.lit(float("-inf")), F.lit("-inf"))
        .when(exp.isNull(), java)
        .otherwise(F.concat(sign, scientific))
    )


def python_text(col: Column | str, dtype: T.DataType) -> Column:
    """``str(value)`` of the value Spark hands to Python, ``None`` for null."""
    c = F.col(col) if isinstance(col, str) else col
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        text = _timestamp_text(c)
    elif isinstance(dtype, (T.DoubleType, T.FloatType)):
        text = _double_text(c)
    elif isinstance(dtype, T.BooleanType):
        text = F.when(c, F.lit("True")).otherwise(F.lit("False"))
    elif isinstance(dtype, T.DateType):
        text = F.date_format(c, "yyyy-MM-dd")
    else:
        text = c.cast("string")
    return F.coalesce(text, F.lit(NONE_TOKEN))


# Digits that Java may print in excess.
EXCESS = 3


def _shorter(digits: Column, exp: Column, value: Column) -> Column:
    """The digits as a whole number ``m`` and how many were left out (``k``), the number as near as may be."""
    n, whole = F.length(digits), digits.cast("decimal(20,0)")

    def number(k: int, up: int) -> Column:
        return (F.floor(whole / F.lit(10**k).cast("decimal(20,0)")) + F.lit(up)).cast("decimal(20,0)")

    def fits(k: int, up: int) -> Column:
        text = F.concat(number(k, up).cast("string"), F.lit("E"), (exp - n + F.lit(1 + k)).cast("string"))
        return (n > k) & (number(k, up) > 0) & (text.try_cast("double") == value)

    out = None
    for k in range(EXCESS, 0, -1):  # as few digits as possible; of two numbers the nearer one
        unit = F.lit(10**k).cast("decimal(20,0)")
        left_out = F.rpad(F.lit("1"), exp + 2 - n + k, F.lit("0")).try_cast("decimal(20,0)")
        exact = value.try_cast("bigint").cast("decimal(20,0)")
        # Java's digits are rounded themselves; a large value that fits a long tells which number is nearer
        nearer_up = F.when(
            (value >= 1e15) & (value < 9.2e18) & left_out.isNotNull(), 2 * (exact % left_out) > left_out
        ).otherwise(2 * (whole % unit) >= unit)
        for ok, up in (
            (nearer_up & fits(k, 1), 1),
            (fits(k, 0), 0),
            (fits(k, 1), 1),
        ):
            one = F.struct(number(k, up).alias("m"), F.lit(k).alias("k"))
            out = F.when(ok, one) if out is None else out.when(ok, one)
    return out.otherwise(F.struct(whole.alias("m"), F.lit(0).alias("k")))


def _from_digits(digits: Column, exp: Column) -> Column:
    """Python's notation of d.ddd x 10^exp: fixed from 1e-4 up to 1e16, else scientific."""
    n = F.length(digits)
    whole = F.when(n <= exp + 1, F.concat(F.rpad(digits, exp + 1, "0"), F.lit(".0"))).otherwise(
        F.concat(F.substring(digits, F.lit(1), exp + 1), F.lit("."), F.substring(digits, exp + 2, F.lit(64)))
    )
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -exp - 1), digits)
    scientific = F.concat(
        F.substring(digits, F.lit(1), F.lit(1)),
        F.when(n > 1, F.concat(F.lit("."), F.substring(digits, F.lit(2), F.lit(64)))).otherwise(F.lit("")),
        F.when(exp < 0, F.lit("e-")).otherwise(F.lit("e+")),
        F.lpad(F.abs(exp).cast("string"), F.greatest(F.lit(2), F.length(F.abs(exp).cast("string"))), F.lit("0")),
    )
    return F.when((exp >= 0) & (exp < 16), whole).when((exp < 0) & (exp >= -4), small).otherwise(scientific)


def python_texts(df: DataFrame, columns: list[str], prefix: str = "_text_") -> DataFrame:
    """``df`` with the text of each column (as ``str`` prints its value) as ``{prefix}{column}``."""
    types = {f.name: f.dataType for f in df.schema.fields}
    doubles = [c for c in columns if isinstance(types[c], (T.DoubleType, T.FloatType))]
    plain = {f"{prefix}{c}": python_text(c, types[c]) for c in columns if c not in doubles}
    if not doubles:
        return df.withColumns(plain)

    def step(fn) -> dict[str, Column]:
        return {f"_{name}_{c}": col for c in doubles for name, col in fn(c).items()}

    def at(name: str, c: str) -> Column:
        return F.col(f"_{name}_{c}")

    def java(c: str) -> dict[str, Column]:
        value = F.col(c).cast("double")
        return {"v": value, "j": F.abs(value).cast("string")}

    def split(c: str) -> dict[str, Column]:
        mant = F.split_part(at("j", c), F.lit("E"), F.lit(1))
        return {
            "i": F.split_part(mant, F.lit("."), F.lit(1)),
            "f": F.split_part(mant, F.lit("."), F.lit(2)),
            "e": F.coalesce(F.split_part(at("j", c), F.lit("E"), F.lit(2)).try_cast("int"), F.lit(0)),
        }

    def digits(c: str) -> dict[str, Column]:
        every = F.concat(at("i", c), at("f", c))
        bare = F.ltrim(every, F.lit("0"))
        # the first digit that isn't 0 has the exponent of its place
        return {
            "d": F.coalesce(F.nullif(F.rtrim(bare, F.lit("0")), F.lit("")), F.lit("0")),
            "x": at("e", c) + F.length(at("i", c)) - 1 - (F.length(every) - F.length(bare)),
        }

    def shorter(c: str) -> dict[str, Column]:
        odd = (at("v", c) != 0) & ~F.isnan(at("v", c)) & (F.abs(at("v", c)) != F.lit(float("inf")))
        excess = odd & ((F.length(at("d", c)) >= 16) | (F.abs(at("v", c)) < 1e-300))
        return {"s": F.when(excess, _shorter(at("d", c), at("x", c), F.abs(at("v", c))))}

    def final(c: str) -> dict[str, Column]:
        found = at("s", c)
        text = found["m"].cast("string")
        return {
            "d2": F.when(found.isNull(), at("d", c)).otherwise(F.rtrim(text, F.lit("0"))),
            "x2": F.when(found.isNull(), at("x", c)).otherwise(
                at("x", c) - F.length(at("d", c)) + found["k"] + F.length(text)
            ),
        }

    def text(c: str) -> Column:
        v = at("v", c)
        sign = F.when(F.startswith(v.cast("string"), F.lit("-")), F.lit("-")).otherwise(F.lit(""))
        body = (
            F.when(F.isnan(v), F.lit("nan"))
            .when(F.abs(v) == F.lit(float("inf")), F.concat(sign, F.lit("inf")))
            .when(v == 0, F.concat(sign, F.lit("0.0")))
            .otherwise(F.concat(sign, _from_digits(at("d2", c), at("x2", c))))
        )
        return F.coalesce(body, F.lit(NONE_TOKEN))

    out = df
    for fn in (java, split, digits, shorter, final):
        out = out.withColumns(step(fn))
    out = out.withColumns({**plain, **{f"{prefix}{c}": text(c) for c in doubles}})
    return out.drop(*(f"_{name}_{c}" for c in doubles for name in ("v", "j", "i", "f", "e", "d", "x", "s", "d2", "x2")))
