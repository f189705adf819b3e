"""Scalar normalisers as Column expressions; null out means that the input says nothing."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from kinfold.functions import policy as P

_NUMBER = "(\\d+(?:\\.\\d+)?)"


def _lookup(table: dict[str, str], key: Column) -> Column:
    return F.create_map(*map(F.lit, chain.from_iterable(table.items())))[key]


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once and named once in the plan, however often body uses it."""
    return F.transform(F.array(value), body)[0]


def _double(text: Column) -> Column:
    return F.nullif(text, F.lit("")).cast("double")


def clean(value: Column) -> Column:
    """Trimmed, inner white space as one space; spellings of nothing become null."""
    return let(F.trim(F.regexp_replace(value, "\\s+", " ")), lambda t: F.when(~F.lower(t).isin(*P.EMPTY), t))


def is_empty(value: Column) -> Column:
    return clean(value).isNull()


def display_name(value: Column) -> Column:
    """First name first; words in one case are capitalised, others stay."""
    word = lambda w: F.when((w == F.upper(w)) | (w == F.lower(w)), F.concat(F.upper(F.substr(w, F.lit(1), F.lit(1))), F.lower(F.substr(w, F.lit(2))))).otherwise(w)

    def flipped(name: Column, parts: Column) -> Column:
        last, first = F.trim(parts[0]), F.trim(F.get(parts, F.lit(1)))
        return F.when((last != "") & (first != ""), F.concat(first, F.lit(" "), last)).otherwise(name)

    name = let(clean(value), lambda n: let(F.split(n, ",", 2), lambda p: flipped(n, p)))
    return F.array_join(F.transform(F.split(name, " "), word), " ")


def name_key(value: Column) -> Column:
    return F.lower(display_name(value))


def profile_handle(value: Column, host: str = "linkedin.com") -> Column:
    """The handle in a profile URL, ``/in/<handle>`` or the older ``/pub/a/b/c``."""

    def of(url: Column) -> Column:
        netloc = F.regexp_extract(url, "^[a-z0-9+.-]*://([^/?#]*)", 1)
        path = F.regexp_replace(F.regexp_extract(url, "^[a-z0-9+.-]*://[^/?#]*([^?#;]*)", 1), "/+$", "")
        return F.when(netloc.contains(host), let(path, from_path))

    def from_path(path: Column) -> Column:
        handle = F.nullif(F.regexp_replace(F.regexp_extract(path, "^/in/(.*)$", 1), "^/+", ""), F.lit(""))
        old = F.array_join(F.filter(F.split(F.regexp_extract(path, "^/pub/(.*)$", 1), "/"), lambda s: s != ""), "-")
        return F.coalesce(handle, F.concat(F.lit("pub-"), F.nullif(old, F.lit(""))))

    return let(F.lower(clean(value)), lambda u: let(F.when(u.startswith("http"), u).otherwise(F.concat(F.lit("https://"), u)), of))


def email(value: Column) -> Column:
    """Lower case, no +tag, one spelling of the domain; null for what isn't an address and for placeholder domains."""

    def of(text: Column) -> Column:
        local, domain = F.split_part(F.substring_index(text, "@", 1), F.lit("+"), F.lit(1)), F.substring_index(text, "@", -1)
        return F.when(
            text.rlike("^[^@\\s]+@[^@\\s]+\\.[^@\\s]+$") & ~domain.isin(*P.JUNK_MAIL),
            F.concat(local, F.lit("@"), F.when(domain.isin(*P.GMAIL), P.GMAIL[0]).otherwise(domain)),
        )

    return let(F.lower(clean(value)), of)


def email_key(address: Column) -> Column:
    """What two spellings of one mailbox share: dots don't count at one provider."""
    return let(address, lambda a: F.when(a.endswith("@" + P.GMAIL[0]), F.concat(F.replace(F.substring_index(a, "@", 1), F.lit("."), F.lit("")), F.lit("@" + P.GMAIL[0]))).otherwise(a))


def email_type(address: Column) -> Column:
    return F.when(F.substring_index(address, "@", -1).isin(*P.FREE_MAIL), "personal").when(address.isNotNull(), "work")


def phone(value: Column, country: str = "91") -> Column:
    """+digits with a country code; null unless 11 to 15 digits, not all the same."""
    full = lambda d: (
        F.when(F.length(d) == 10, F.concat(F.lit(country), d)).when((F.length(d) == 11) & d.startswith("0"), F.concat(F.lit(country), F.substr(d, F.lit(2)))).otherwise(d)
    )
    several = lambda d: F.size(F.array_distinct(F.split(F.regexp_replace(d, f"^{country}", ""), ""))) > 1
    digits = F.regexp_replace(F.regexp_replace(F.regexp_replace(clean(value), "[^0-9+]", ""), "^\\++", ""), "^00", "")
    return let(let(digits, full), lambda d: F.when(F.length(d).between(11, 15) & several(d), F.concat(F.lit("+"), d)))


def location(value: Column) -> Column:
    """struct<raw, city, state, country>; the first known city wins, later abbreviations of states override."""
    return let(clean(value), _location)


def _location(raw: Column) -> Column:
    tokens = F.filter(F.transform(F.split(raw, "[,/]"), lambda t: F.lower(F.trim(t))), lambda t: t != "")
    city, state, country = ({k: v[i] for k, v in P.CITIES.items()} for i in range(3))
    nothing = F.lit(None).cast("string")
    found = F.aggregate(
        tokens,
        F.struct(nothing.alias("city"), nothing.alias("state"), nothing.alias("country")),
        lambda a, t: F.struct(
            F.coalesce(a["city"], _lookup(city, t)).alias("city"),
            F.when(a["city"].isNull() & _lookup(state, t).isNotNull(), _lookup(state, t)).otherwise(F.coalesce(_lookup(P.STATES, t), a["state"])).alias("state"),
            F.when(a["city"].isNull() & _lookup(country, t).isNotNull(), _lookup(country, t)).when(t == "india", "IN").otherwise(F.coalesce(a["country"], F.when(_lookup(P.STATES, t).isNotNull(), "IN"))).alias("country"),
        ),
    )
    return let(found, lambda f: F.struct(raw.alias("raw"), f["city"].alias("city"), f["state"].alias("state"), F.coalesce(f["country"], F.when(F.lower(raw).contains("india"), "IN")).alias("country")))


def skills(items: Column) -> Column:
    """Cleaned lower-case items under one spelling, in order of first appearance."""
    one = lambda s: let(F.lower(clean(s)), lambda x: F.coalesce(_lookup(P.SKILL_ALIASES, x), x))
    return F.coalesce(F.array_distinct(F.filter(F.transform(items, one), lambda s: s.isNotNull() & (s != ""))), F.array().cast("array<string>"))


def experience_months(value: Column) -> Column:
    def of(text: Column) -> Column:
        years, months = (_double(F.regexp_extract(text, _NUMBER + unit, 1)) for unit in ("\\s*(?:years?|yrs?)", "\\s*(?:months?|mos?)"))
        plain = _double(F.regexp_extract(text, "^" + _NUMBER + "\\+?$", 1))
        both = let(F.struct(years.alias("y"), months.alias("m")), lambda x: F.when(x["y"].isNotNull() | x["m"].isNotNull(), F.coalesce(x["y"], F.lit(0.0)) * 12 + F.coalesce(x["m"], F.lit(0.0))))
        return F.coalesce(both, plain * 12)

    return F.bround(let(F.lower(clean(value)), of)).cast("int")


def salary_inr(value: Column) -> Column:
    def of(text: Column) -> Column:
        monthly = text.contains("per month") | text.contains("/month") | F.replace(text, F.lit(" "), F.lit("")).contains("pm")
        return _double(F.regexp_extract(text, _NUMBER, 1)) * F.when(text.contains("lpa") | text.contains("lakh"), 100_000).when(monthly, 12).otherwise(1)

    return F.bround(let(F.lower(clean(value)), of)).cast("long")


def notice_days(value: Column) -> Column:
    def of(text: Column) -> Column:
        number = _double(F.regexp_extract(text, _NUMBER, 1))
        return F.when(text.contains("immediate"), 0.0).otherwise(number * F.when(text.contains("week"), 7).when(text.contains("month"), 30).otherwise(1))

    return F.bround(let(F.lower(clean(value)), of)).cast("int")


def company_key(value: Column) -> Column:
    key = F.regexp_replace(F.lower(clean(value)), "^@", "")
    for suffix in P.COMPANY_SUFFIXES:
        key = F.trim(F.regexp_replace(key, suffix.replace(".", "\\.") + "$", ""))
    return F.nullif(key, F.lit(""))


def content_hash(json: Column) -> Column:
    """Of a JSON object, whatever the order of its keys and its white space; of any other line, of its text."""
    return F.sha2(F.coalesce(F.to_json(F.try_parse_json(json)), F.trim(json)), 256)


def deterministic_id(prefix: str, *parts: Column) -> Column:
    return F.concat(F.lit(prefix), F.substr(F.sha2(F.to_json(F.struct(*parts)), 256), F.lit(1), F.lit(26)))


def fixed(x: Column, places: int) -> Column:
    """A double with ``places`` (1 to 7) decimals as C and Python print it: rounded by its exact binary value, ties to even.

    Java's formatter, and ``format_string`` with it, rounds the shortest decimal instead, which makes ties of what is none.
    """
    scale, size = 10**places, F.abs(x)
    whole = F.floor(size)
    part = size - whole
    # part * scale without rounding, as the sum of two products: the high half of the bits and the low one.
    wide = part * 134_217_729.0
    high = wide - (wide - part)
    down = F.floor(part * scale)
    beyond = (high * scale - (down + 0.5)) + (part - high) * scale
    near = down + F.when(beyond > 0, 1).when(beyond == 0, down % 2).otherwise(0)
    text = F.concat((whole + F.when(near == scale, 1).otherwise(0)).cast("string"), F.lit("."), F.lpad((near % scale).cast("string"), places, "0"))
    exact = F.concat(F.when(x.cast("string").startswith("-"), "-").otherwise(""), text)
    # From 2 to the 62nd on a double has no fraction and its shortest decimal is printed; so are infinities and NaN.
    return F.when(size < 2.0**62, exact).when(x.isNotNull(), F.format_string(f"%.{places}f", x))
