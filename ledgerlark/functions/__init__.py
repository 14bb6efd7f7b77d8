"""Column functions: text, dates and numbers. All are built-in expressions; none is a Python UDF."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

MONTHS = ("January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December")
#: Fixed value: a text is tagged if it has six decimal digits of any script in a row, or "eventid" in any case, also with a dotless or dotted i.
EVENT_ID = r"(?iU)(\d{6}|event[iİı]d)"
#: The white space that is trimmed.
BLANK = "\t\n\x0b\x0c\r \u00a0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000\ufeff"
#: Fixed value: a label of 3 to 60 characters, none of them : or a full stop, and the rest after a colon and white space.
LABEL = rf"(?s)\A([^:.]{{3,60}}):[{BLANK}]+(.+)\z"


def has_event_id(*columns: Column) -> Column:
    """Whether any of the texts is tagged; a null text is not."""
    return reduce(lambda a, b: a | b, [F.coalesce(c.rlike(EVENT_ID), F.lit(False)) for c in columns])


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(BLANK))


def title_case(c: Column) -> Column:
    """First letter upper case, the rest untouched."""
    return F.concat(F.upper(F.left(c, F.lit(1))), F.substr(c, F.lit(2)))


def ordinal(n: Column) -> Column:
    """1st, 2nd, 3rd, 4th, 11th..."""
    teen = (n % 100).between(11, 13)
    ending = F.when(teen, "th").when(n % 10 == 1, "st").when(n % 10 == 2, "nd").when(n % 10 == 3, "rd").otherwise("th")
    return F.concat(n.cast("string"), ending)


def label_prefix(c: Column) -> Column:
    """`label: rest` becomes `**label:** rest`."""
    return F.regexp_replace(c, LABEL, r"**$1:** $2")


def first_line(c: Column) -> Column:
    return F.split_part(strip(c), F.lit("\n"), F.lit(1))


def bullets(c: Column) -> Column:
    """Lines as markdown: blank lines go; one line stays a paragraph; a first line that ends with a colon
    and has no tab before it introduces, with an empty line after it; every other line is a bullet, its
    tabs are its depth, and its label is bold."""
    lines = F.filter(F.transform(F.split(c, "\n"), lambda x: F.rtrim(x, F.lit(BLANK))), lambda x: strip(x) != "")
    first = strip(F.get(lines, F.lit(0)))
    intro = ~F.get(lines, F.lit(0)).startswith("\t") & first.endswith(":")

    def bullet(x: Column) -> Column:
        depth = F.length(x) - F.length(F.ltrim(x, F.lit("\t")))
        return F.concat(F.repeat(F.lit("  "), depth), F.lit("- "), label_prefix(strip(x)))

    after = F.transform(F.when(intro, F.slice(lines, F.lit(2), F.greatest(F.size(lines) - 1, F.lit(0)))).otherwise(lines), bullet)
    whole = F.array_join(F.concat(F.when(intro, F.array(first, F.lit(""))).otherwise(F.array().cast("array<string>")), after), "\n")
    return F.when(F.size(lines) == 0, "").when(F.size(lines) == 1, first).otherwise(whole)


def _yaml(v: Column) -> Column:
    return F.regexp_extract(F.to_json(F.struct(v.alias("v"))), r'(?s)^\{"v":(.*)\}$', 1)


def front_matter(**fields: Column) -> Column:
    """A block of `name: value` lines between rules; text is quoted, null fields are left out."""
    lines = [F.when(v.isNotNull(), F.concat(F.lit(f"{k}: "), _yaml(v))) for k, v in fields.items()]
    return F.concat_ws("\n", F.lit("---"), *lines, F.lit("---"))


def yaml_list(name: str, items: Column, fields: list[str]) -> Column:
    """A front matter field that is a list: a line for each field of each struct, the first marked with a dash."""
    item = lambda x: F.concat_ws("\n", *[F.concat(F.lit(f"  {'- ' if i == 0 else '  '}{f}: "), F.when(x[f].isNull(), "null").otherwise(_yaml(x[f]))) for i, f in enumerate(fields)])
    return F.concat_ws("\n", F.lit(f"{name}:"), F.transform(items, item))


def natural_key(c: Column, mark: str) -> list[Column]:
    """Sort keys of `text<mark>number`: the text, then the number as a number."""
    return [F.split_part(c, F.lit(mark), F.lit(1)), F.try_to_number(F.nullif(F.regexp_extract(c, r"(\d+)$", 1), F.lit("")), F.lit("999999999999")).cast("long")]


def owner_of(url: Column) -> Column:
    """First part of a URL's path; null where there is none."""
    return F.nullif(F.get(F.split(F.try_parse_url(url, F.lit("PATH")), "/"), F.lit(1)), F.lit(""))


def round4(x: Column) -> Column:
    """Four places, halves to even after scaling."""
    return F.rint(x * 10000) / 10000


def to_number(c: Column) -> Column:
    """A plain decimal number, or null; infinities, NaN and suffixed literals are null."""
    return F.when(strip(c).rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), strip(c).try_cast("double"))


def percent(part: Column, whole: Column) -> Column:
    """Part of the whole in per cent, 0 of nothing."""
    return F.coalesce(F.try_divide(part * F.lit(100.0), F.nullif(whole, F.lit(0))), F.lit(0.0))


def tick_step(top: Column) -> Column:
    """The smallest of 1, 2, 5, 10 times a power of ten of which four reach the top."""
    power = F.pow(F.lit(10.0), F.floor(F.log10(F.greatest(top, F.lit(1)) / 4.0)))
    steps = F.transform(F.array(*map(F.lit, (1.0, 2.0, 5.0, 10.0))), lambda m: m * power)
    return F.get(F.filter(steps, lambda s: s * 4 >= F.greatest(top, F.lit(1))), F.lit(0))


def ticks(top: Column) -> Column:
    """The marks of an axis: 0 and every step up to the top, 1 at least."""
    step = tick_step(top)
    return F.transform(F.sequence(F.lit(0).cast("long"), F.floor(F.greatest(top, F.lit(1)) / step)), lambda i: i * step)


def number_or_zero(c: Column) -> Column:
    """A number from text, 0 for a null or blank one, null for any other text."""
    return F.when(F.coalesce(strip(c), F.lit("")) == "", 0.0).otherwise(to_number(c))


def rounded_up(x: Column) -> Column:
    """The nearest whole number, halves up."""
    return F.floor(x + 0.5)


def one_place(x: Column) -> Column:
    """Text with one decimal place."""
    return F.format_string("%.1f", x.cast("double"))


def parties(controls: Column) -> Column:
    """D for each `Democratic`, R for any other, joined by /."""
    return F.array_join(F.transform(controls, lambda c: F.when(c == "Democratic", "D").otherwise("R")), "/")


def chamber_controls(chambers: Column, house: Column, senate: Column) -> Column:
    """`Chamber: control` of each chamber, joined by a middle dot; an em dash where the control is unknown."""
    control = lambda c: F.coalesce(F.when(c == "senate", senate).otherwise(house), F.lit("—"))
    return F.array_join(F.transform(chambers, lambda c: F.concat(title_case(c), F.lit(": "), control(c))), " · ")


def zulu(c: Column) -> Column:
    """The time of `2025-01-02T03:04:05Z`; any other text raises."""
    return F.to_timestamp(c, "yyyy-MM-dd'T'HH:mm:ssX")


def zulu_text(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def month_start(c: Column) -> Column:
    return F.trunc(c.cast("date"), "MM")


def month_number(name: Column) -> Column:
    return F.nullif(F.array_position(F.array(*map(F.lit, MONTHS)), name), F.lit(0)).cast("int")


def float_year_date(y: Column) -> Column:
    """Date of a year with a fraction: the fraction of 365.25 days after its first day."""
    return F.date_add(F.make_date(F.floor(y).cast("int"), F.lit(1), F.lit(1)), F.floor((y - F.floor(y)) * 365.25).cast("int"))


def inflated(amount: Column, index_then: Column, index_now: Column) -> Column:
    return amount * F.try_divide(index_now, index_then)
