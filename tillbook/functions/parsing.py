"""Text to typed values.

The raw load is strict: bad text fails it. Later steps turn bad text into NULL. Only ``try_*``
functions and explicit errors are used, so results do not depend on whether the session runs in
ANSI mode.
"""

from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillbook.schema import NA_TOKENS

_WIDE = "decimal(38,18)"


def missing_to_null(text: Column) -> Column:
    return F.when(~text.isin(NA_TOKENS), text)


def _fail(name: Column, text: Column, problem: str) -> Column:
    return F.raise_error(F.concat(F.lit("column "), name, F.lit(f": {problem}: "), text))


def _finer(text: Column) -> Column:
    """Whether a number has more than the 18 decimals that the wide type keeps."""
    decimals = F.length(F.regexp_extract(text, r"\.(\d*?)0*[eE]", 1))
    exponent = F.coalesce(F.regexp_extract(text, r"[eE]\+?(-?\d+)", 1).try_cast("int"), F.lit(0))
    return F.when(text.rlike("[eE]"), text.rlike("[1-9].*[eE]") & (decimals - exponent > 18)).otherwise(text.rlike(r"\.\d{18}\d*[1-9]"))


def lossy(text: Column, data_type: T.DecimalType) -> Column:
    """Whether a number text has more decimals than ``data_type``; false for other texts."""
    wide = text.try_cast(_WIDE)
    return F.coalesce(wide.isNotNull() & (_finer(text) | ~wide.try_cast(data_type).eqNullSafe(wide)), F.lit(False))


def _whole(wide: Column) -> Column:
    return F.round(wide, 0).try_cast("int")


def _plain(data_type: T.DataType) -> str:
    """Pattern of number texts that surely fit the type; others may fit as well."""
    if isinstance(data_type, T.DecimalType):
        return rf"-?\d{{1,{data_type.precision - data_type.scale}}}(?:\.\d{{1,{data_type.scale}}})?"
    return r"-?\d{1,9}"


def numbers_fit(texts: dict[str, T.DataType], round_digits: bool = False) -> Column:
    """Row filter that is always true, or an error that names the text that is no such number. With
    ``round_digits``, more decimals than the type has are no error.

    Rows of plain numbers pass by a single pattern over all columns. Only a row with another text
    takes the careful way, written as a loop over the columns of one type: as an expression per
    column the generated code grows beyond what the JVM compiles.
    """

    def careful(data_type, names):
        def check(field):
            name, text = field["name"], field["text"]
            wide = text.try_cast(_WIDE)
            result = F.when(text.isNull(), True)
            if isinstance(data_type, T.DecimalType):
                result = result.when(wide.isNull(), _fail(name, text, "not a number"))
                finer = text.try_cast(data_type).isNull() if round_digits else lossy(text, data_type)
                result = result.when(finer, _fail(name, text, "does not fit"))
            else:
                result = result.when(_whole(wide).isNull(), _fail(name, text, "not an integer"))
            return result.otherwise(True)

        fields = [F.struct(F.lit(n).alias("name"), F.col(n).alias("text")) for n in names]
        return F.forall(F.array(*fields), check)

    joined = F.concat_ws(";", *[F.coalesce(n, F.lit("0")) for n in texts])
    plain = joined.rlike("^" + ";".join(_plain(t) for t in texts.values()) + "$")
    by_type = {t: [n for n in texts if texts[n] == t] for t in texts.values()}
    return F.when(plain, True).otherwise(reduce(and_, [careful(t, names) for t, names in by_type.items()]))


def exact_decimal(text: Column, data_type: T.DecimalType, name: str) -> Column:
    """Parse a number, NULL when it is none; digits beyond the column's scale are an error."""
    return (
        F.when(lossy(text, data_type), _fail(F.lit(name), text, "does not fit"))
        .otherwise(text.try_cast(_WIDE).try_cast(data_type))
        .cast(data_type)
    )


def whole_number(text: Column) -> Column:
    """Parse an integer, NULL when the text is no number; a fraction is rounded half away from
    zero, as an INTEGER column does."""
    return F.coalesce(text.try_cast("int"), _whole(text.try_cast(_WIDE)))


def sale_date(text: Column, pattern: str) -> Column:
    return F.try_to_date(text, pattern)


def sale_time(text: Column) -> Column:
    """A time of day as ``HH:mm:ss`` with up to six decimals; NULL when the text is none.

    Takes ``7:08``, ``13:08:09.5``, twelve-hour times like ``8:59:00 PM``, and ``24:00:00``, the end of
    the day, which stays as it is.
    """
    # nearly all times are plain; only the others take the careful way
    plain = F.try_to_timestamp(text, F.lit("H:mm[:ss]"))
    trimmed = F.trim(text)
    seconds = "mm[:ss[.SSSSSS]]"
    parsed = F.coalesce(*[F.try_to_timestamp(trimmed, F.lit(f"{hour}:{seconds}{half}")) for hour, half in (("H", ""), ("h", "[ ]a"), ("K", "[ ]a"))])
    end_of_day = trimmed.rlike(r"^24:00(:00(\.0{1,6})?)?$")
    return (
        F.when(plain.isNotNull(), F.date_format(plain, "HH:mm:ss"))
        .when(end_of_day, "24:00:00")
        .otherwise(F.regexp_replace(F.date_format(parsed, "HH:mm:ss.SSSSSS"), r"\.?0{1,6}$", ""))
    )
