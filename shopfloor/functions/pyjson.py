"""JSON text exactly as Python's ``json.dumps`` writes it, in column expressions.

Floats: Python and the JVM both write the shortest digits that give the number back, but lay them out
differently (``0.0003`` and ``3.0E-4``; exponents from 1e16 and below 1e-4 on), and older JVMs write a
digit too many for some numbers, which is rounded off where the rounded text still gives the number back
(between 1e17 and 1e31, where their last digit may be wrong, from the number's whole value).
Strings: everything but printable ASCII is escaped, by UTF-16 unit. Common values (few digits, plain
ASCII) take a short way of built-in functions; the rest is worked out only where it is needed.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Text that needs no escapes: printable ASCII without the quote and the backslash.
PLAIN = r"^[ !#-\[\]-~]*$"
#: Escapes of single UTF-16 units (four hex digits) that aren't ``\uXXXX``. Fixed values.
SHORT_ESCAPES = {"0008": "\\b", "0009": "\\t", "000A": "\\n", "000C": "\\f", "000D": "\\r", "0022": '\\"', "005C": "\\\\"}
#: Decimal exponents (of 0.digits) that are written without ``e``.
FIXED_FROM, FIXED_TO = -3, 16
MOST_DIGITS_PLAIN = 15
#: Text without the letters of exponents, infinities and NaN.
PLAIN_FLOATS = r"^[^EIN]*+$"
#: Powers of ten that a double holds exactly, and the size up to which it holds every whole number.
EXACT_POWERS, EXACT_WHOLE = 22, 1 << 53
#: Where digits are taken from the whole value, which is split at 2**40 into two parts that are exact.
WHOLE_FROM, WHOLE_TO, SPLIT = 1e17, 1e31, float(1 << 40)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def float_text(x: Column) -> Column:
    """``repr`` of a double; null for null."""
    text = x.cast("string")
    short = ~text.contains("E") & (F.length(text) <= MOST_DIGITS_PLAIN)
    return F.when(short, text).otherwise(let(F.abs(x), lambda size: F.concat(
        F.when(text.startswith("-"), F.lit("-")).otherwise(F.lit("")), _long_text(size))))


def _long_text(x: Column) -> Column:
    """Of a number that isn't negative, from the JVM's text of it."""
    def parsed(text: Column) -> Column:
        mantissa, fraction = F.split_part(text, F.lit("E"), F.lit(1)), F.split_part(
            F.split_part(text, F.lit("E"), F.lit(1)), F.lit("."), F.lit(2))
        exponent = F.coalesce(F.nullif(F.split_part(text, F.lit("E"), F.lit(2)), F.lit("")).cast("int"), F.lit(0))
        return F.struct(F.replace(mantissa, F.lit("."), F.lit("")).cast("long").alias("digits"),
                        (exponent - F.length(fraction)).alias("power"))

    def rounded(number: Column) -> Column:
        fewer = F.call_function("div", number["digits"] + 5, F.lit(10).cast("long"))
        again = F.concat(fewer.cast("string"), F.lit("E"), (number["power"] + 1).cast("string")).cast("double")
        return F.when((number["digits"] >= 10) & (again == x), F.struct(fewer.alias("digits"), (number["power"] + 1).alias("power"))
                      ).otherwise(number)

    def whole(value: Column) -> Column:
        """Of the value as a decimal: rounded to 15, 16 or 17 digits, the fewest that read as ``x``."""
        def of(n: int) -> Column:
            cut = F.length(value.cast("string")) - n
            unit = F.concat(F.lit("1"), F.repeat(F.lit("0"), cut)).cast("decimal(38,0)")
            down, rest = F.call_function("div", value, unit), value % unit
            up = (rest * 2 > unit) | ((rest * 2 == unit) & (down % 2 == 1))
            return F.struct((down + up.cast("long")).alias("digits"), cut.alias("power"))

        def reads(n: Column) -> Column:
            return F.concat(n["digits"].cast("string"), F.lit("E"), n["power"].cast("string")).cast("double") == x

        return F.when(reads(of(15)), of(15)).when(reads(of(16)), of(16)).otherwise(of(17))

    high = F.floor(x / SPLIT).cast("long")
    value = (high.cast("decimal(25,0)") * F.lit(1 << 40).cast("decimal(13,0)")
             + (x - high.cast("double") * SPLIT).cast("long").cast("decimal(13,0)")).cast("decimal(38,0)")

    def laid_out(number: Column) -> Column:
        return let(number["digits"].cast("string"), lambda every: let(
            F.struct(F.rtrim(every, F.lit("0")).alias("d"), (F.length(every) + number["power"]).alias("point")), written))

    def written(n: Column) -> Column:
        digits, point = n["d"], n["point"]
        size, zeros = F.length(digits), F.lit("0")
        power = point - 1
        exponent = F.concat(F.when(power < 0, F.lit("e-")).otherwise(F.lit("e+")), F.lpad(F.abs(power).cast("string"),
                            F.greatest(F.lit(2), F.length(F.abs(power).cast("string"))), zeros))
        one = F.concat(F.substring(digits, 1, 1), F.when(size > 1, F.concat(F.lit("."), F.substring(digits, F.lit(2), size)))
                       .otherwise(F.lit("")), exponent)
        return (F.when((point < FIXED_FROM) | (point > FIXED_TO), one)
                .when(point <= 0, F.concat(F.lit("0."), F.repeat(zeros, -point), digits))
                .when(point >= size, F.concat(digits, F.repeat(zeros, point - size), F.lit(".0")))
                .otherwise(F.concat(F.substring(digits, F.lit(1), point), F.lit("."), F.substring(digits, point + 1, size))))

    number = F.when((x >= WHOLE_FROM) & (x < WHOLE_TO), let(value, whole)).otherwise(
        let(parsed(x.cast("string")), lambda n: let(rounded(n), rounded)))
    finite = let(number, laid_out)
    return F.when(F.isnan(x) | (x == float("inf")), x.cast("string")).otherwise(finite)


def _shortest(text: Column) -> Column:
    """Whether the JVM's text of a double has no digit too many. Where that isn't sure, false or null."""
    def needed(text: Column) -> Column:
        fewer = F.call_function("div", F.replace(text, F.lit("."), F.lit("")).try_cast("long") + 5, F.lit(10).cast("long"))
        places = F.length(text) - F.instr(text, ".") - 1
        power = F.try_element_at(F.array(*[F.lit(float(10 ** n)) for n in range(EXACT_POWERS + 1)]), places + 1)
        # A quotient of two exact doubles is the double that the digits read as.
        return (fewer < EXACT_WHOLE) & (fewer.cast("double") / power != text.cast("double"))

    return F.when(F.length(text) <= MOST_DIGITS_PLAIN, True).when(
        ~text.contains("E"), let(F.replace(text, F.lit("-"), F.lit("")), needed))


def floats_text(values: Column, names: Sequence[str]) -> Column:
    """An object of the entries of a map of doubles that aren't null.

    Where all keys are among ``names`` (plain text, in lower case) and the JVM's digits are sure to be Python's, one
    built-in function writes it. The rest, and maps that repeat a key, go entry by entry."""
    known = F.filter(F.coalesce(F.map_entries(values), F.array().cast("array<struct<key:string,value:double>>")),
                     lambda e: e["value"].isNotNull())
    found = sum((values[n].isNotNull().cast("int") for n in names[1:]), values[names[0]].isNotNull().cast("int"))
    text = F.to_json(F.struct(*[values[n].alias(n) for n in sorted(names)]))
    plain = F.when((found == F.size(values)) & F.forall(F.map_values(values).cast("array<string>"), _shortest),
                   F.nullif(F.regexp_extract(text, PLAIN_FLOATS, 0), F.lit("")))
    return F.coalesce(plain, object_text(known, float_text))


def string_text(c: Column) -> Column:
    """A quoted string; ``null`` for null."""
    def escaped(unit: Column) -> Column:
        out = F
        for code, text in SHORT_ESCAPES.items():
            out = out.when(unit == code, F.lit(text))
        out = out.when((unit >= "0020") & (unit <= "007E"), F.char(F.conv(unit, 16, 10).cast("long")))
        return out.otherwise(F.concat(F.lit("\\u"), F.lower(unit)))

    def units(digits: Column) -> Column:
        places = F.sequence(F.lit(0), F.floor(F.length(digits) / 4) - 1)
        return F.transform(places, lambda i: F.substring(digits, (i * 4 + 1).cast("int"), F.lit(4)))

    every = let(F.hex(F.encode(c, "UTF-16BE")), lambda digits: F.array_join(F.transform(
        units(digits), escaped), ""))
    body = F.when(c.rlike(PLAIN), c).otherwise(every)
    return F.coalesce(F.concat(F.lit('"'), body, F.lit('"')), F.lit("null"))


def object_text(entries: Column, text: Callable[[Column], Column]) -> Column:
    """An object of (key, value) entries, in order of the keys; ``text`` gives a value's text."""
    members = F.transform(F.array_sort(entries), lambda e: F.concat(string_text(e["key"]), F.lit(":"), text(e["value"])))
    return F.concat(F.lit("{"), F.array_join(members, ","), F.lit("}"))
