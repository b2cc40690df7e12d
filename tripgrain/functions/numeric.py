"""Rounding, exact sums, means and ratios."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A sum of doubles is kept in limbs: whole multiples of 2^LOWEST, 2^(LOWEST + 24), ..., each added up as a long.
LOWEST, LIMB_BITS, LIMBS = -114, 24, 8
LARGEST = 2.0 ** (LOWEST + LIMB_BITS * LIMBS - 1)  # about 1.5e23; a value must be below it
MOST_TERMS = 1 << 39  # a limb of a value has at most 23 bits and a sign, so no long overflows before
TERMS = "terms"


def as_double(c: Column) -> Column:
    return c.cast("double")


def round_to(c: Column, places: int = 0) -> Column:
    """Round the *binary* value half away from zero.

    `F.round(x, 2)` rounds the shortest decimal text of x, so 1.005 becomes 1.01. The reports scale,
    round to an integer and scale back, which gives 1.0 because 1.005 is stored slightly below the tie.
    """
    if places == 0:
        return F.round(as_double(c))
    factor = F.lit(float(10**places))
    return F.round(as_double(c) * factor) / factor


def is_parts(df: DataFrame, name: str) -> bool:
    """Whether a column holds a sum in limbs."""
    kind = df.schema[name].dataType
    return isinstance(kind, T.StructType) and kind.names[:1] == [TERMS]


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _power(exponent: int) -> str:
    return repr(2.0**exponent) + "D"


def _limb_text(value: str, k: int) -> str:
    """The k-th limb: the value in units of that limb, rounded, less what the limb above holds. All steps are exact."""
    rounded = [f"rint({value} * {_power(-(LOWEST + LIMB_BITS * j))})" for j in (k, k + 1)]
    return f"cast({rounded[0]} AS bigint)" if k + 1 == LIMBS else f"cast({rounded[0]} - {rounded[1]} * {_power(LIMB_BITS)} AS bigint)"


def _parts_text(column: str) -> dict[str, str]:
    """SQL of the aggregates behind a sum in limbs."""
    value = f"double({_quoted(column)})"
    finest = f"{value} * {_power(-LOWEST)}"
    message = column.replace("\\", "\\\\").replace("'", "\\'")
    refuse = f"cast(raise_error(concat('{message} can\\'t be summed: ', cast({value} AS string))) AS double)"
    # the comparison is false for infinity; NaN exceeds any number
    fits = f"abs({value}) < {LARGEST!r}D AND rint({finest}) = {finest}"
    checked = f"CASE WHEN {value} IS NULL OR ({fits}) THEN {value} ELSE {refuse} END"
    limbs = {f"limb{k}": f"sum({_limb_text(checked, k)})" for k in range(LIMBS)}
    return {TERMS: f"count({value})", **limbs}


def _added_text(column: str) -> dict[str, str]:
    return {field: f"sum({_quoted(column)}.{field})" for field in (TERMS, *(f"limb{k}" for k in range(LIMBS)))}


def _struct(fields: dict[str, str]) -> Column:
    return F.expr("named_struct(" + ", ".join(f"'{name}', {text}" for name, text in fields.items()) + ")")


def _value_of(fields: dict[str, str]) -> Column:
    """The double nearest to a sum in limbs; null for a sum of nothing.

    Carries turn limbs into digits between -2^23 and 2^23, so the first digit that is not zero decides the sign. From it
    on, four digits make two numbers of at most 48 bits that doubles hold exactly; what is below matters only by its
    sign. The one addition that rounds then gives the nearest double.
    """
    half, mask, room = 1 << LIMB_BITS - 1, (1 << LIMB_BITS) - 1, 3  # room for the carries of the highest limb
    limbs = ", ".join([*(f"coalesce({fields[f'limb{k}']}, 0L)" for k in range(LIMBS)), *["0L"] * room])
    whole = f"x + held.carry + {half}L"
    step = f"named_struct('carry', shiftright({whole}, {LIMB_BITS}), 'd', array_append(held.d, ({whole} & {mask}L) - {half}L))"
    digits = f"aggregate(array({limbs}), named_struct('carry', 0L, 'd', array(0L, 0L, 0L, 0L)), (held, x) -> {step}, held -> held.d)"
    units = ", ".join(_power(LOWEST + LIMB_BITS * (k - 3 - 4)) for k in range(4 + LIMBS + room))
    pair = lambda k: f"cast(d[t - {k}] * {1 << LIMB_BITS}L + d[t - {k + 1}] AS double)"
    below = "signum(aggregate(slice(d, 1, t - 3), 0L, (held, x) -> if(x = 0L, held, x)))"
    nearest = f"({pair(0)} * {_power(2 * LIMB_BITS)} + ({pair(2)} + {below} * 0.5D)) * array({units})[t]"
    top = "array_max(transform(d, (x, k) -> if(x = 0L, -1, k)))"
    found = f"transform(array({top}), t -> if(t < 0, 0.0D, {nearest}))[0]"
    value = f"transform(array({digits}), d -> {found})[0]"  # a lambda's variable is computed once
    terms = f"coalesce({fields[TERMS]}, 0L)"
    too_many = f"cast(raise_error('more than {MOST_TERMS} values in one exact sum') AS double)"
    return F.expr(f"CASE WHEN {terms} > {MOST_TERMS}L THEN {too_many} WHEN {terms} > 0L THEN {value} END")


def _is_floating(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType))


def exact_parts(df: DataFrame, name: str) -> Column:
    """SUM in a form that adds up without rounding: a struct of limbs for a floating-point column, else the plain sum.

    Floating-point addition is not associative, so a retried task could change the last digits of a published total or
    tip a rounded mean over a tie. Limbs are whole numbers, so their sums depend on nothing but the values. Nulls are
    skipped. NaN, an infinity, 2^77 or more, or digits below 2^-114 raise an error, with or without ANSI mode: a total
    that leaves something out would be published as if it were sound.
    """
    return _struct(_parts_text(name)) if _is_floating(df, name) else F.sum(name)


def add_parts(df: DataFrame, name: str) -> Column:
    """The sum of a column of sums, still in parts where they are."""
    return _struct(_added_text(name)) if is_parts(df, name) else F.sum(name)


def exact_sum(df: DataFrame, name: str) -> Column:
    """SUM as one value: for floating-point columns the double nearest to the sum of the stored binary values, for others
    the plain sum. See `exact_parts` for what it refuses."""
    return _value_of(_parts_text(name)) if _is_floating(df, name) else F.sum(name)


def sum_of_parts(df: DataFrame, name: str) -> Column:
    """The sum of a column of sums as one value."""
    return _value_of(_added_text(name)) if is_parts(df, name) else F.sum(name)


def mean_of_parts(df: DataFrame, name: str) -> Column:
    """The mean of a column of sums over the rows that have one."""
    column = F.col(_quoted(name))
    return ratio(sum_of_parts(df, name), F.count_if(column[TERMS] > 0) if is_parts(df, name) else F.count(column))


def with_values(df: DataFrame) -> DataFrame:
    """`df` with every sum in parts as a double."""

    def value(name: str) -> Column:
        fields = {field: f"{_quoted(name)}.{field}" for field in _added_text(name)}
        return _value_of(fields).alias(name) if is_parts(df, name) else F.col(_quoted(name))

    return df.select(*map(value, df.columns))


def mean(c: Column, over: Column | None = None) -> Column:
    """Average of the non-null values, as a double; `over` names another denominator."""
    return as_double(F.sum(c)) / as_double(F.count(c) if over is None else over)


def ratio(a: Column, b: Column) -> Column:
    """Floating-point a / b; null where either is null or the denominator is zero."""
    return as_double(a) / F.nullif(as_double(b), F.lit(0.0))


def percent(a: Column, b: Column) -> Column:
    return F.lit(100.0) * as_double(a) / F.nullif(as_double(b), F.lit(0.0))
