"""Derived WARC records: from responses to linked metadata and plain text.

Every response gives a ``metadata`` record, with what its headers and markup
say, and a ``conversion`` record, with its text. Both name the response they
refer to, and keep its target, its date and the digest of its payload; the
metadata record also keeps its headers. Identifiers are made from content, so a
task that runs again makes the same records. Everything is built-in functions
and no row leaves its task.

A record is a row; ``write`` writes rows as files of WARC records, and ``read``
reads such files back.
"""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

VERSION = "WARC/1.1"
DATE = "1970-01-01T00:00:00Z"
RECORD = (
    "type", "record_id", "refers_to", "target_uri", "date", "content_type",
    "content_length", "block_digest", "source_digest", "block",
)

_HIDDEN = r"(?is)<!--.*?-->|<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>"
_BLOCKS = (
    r"(?i)</?(address|article|aside|blockquote|body|br|dd|div|dl|dt|footer|form|h[1-6]|head|header|hr|html"
    r"|li|main|nav|ol|option|p|pre|section|select|table|td|th|title|tr|ul)\b[^>]*>"
)
_TAGS = r"</?[a-zA-Z!?][^>]*>"
_TITLE = r"(?is)<title[^>]*>(.*?)</title"
_LINK = r"""(?i)<a\s[^>]*?href\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
_QUOTES = r"""^["']|["']$"""


def _digest(text: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(text, 256))


def _record_id(*parts: Column) -> Column:
    """An identifier made from content, in the form of a UUID."""
    name = F.md5(F.concat_ws("\u001f", *parts))
    return F.regexp_replace(name, r"^(.{8})(.{4})(.{4})(.{4})(.{12})$", "<urn:uuid:$1-$2-$3-$4-$5>")


# All names of entities, older ones first; a no-break space is a space.
_NAMES = {
    name: html5[name].replace("\u00a0", " ")
    for name in sorted(html5, key=lambda name: (name.rstrip(";") not in html5, name))
}
# Those that may lack the semicolon, longest first.
_OPEN = "|".join(sorted((name for name in html5 if name[-1] != ";"), key=len, reverse=True))
# Numbers, in hex digits, that stand for something else than their code point.
_NUMBERS = {"0": "\ufffd", "D": "\r", "A0": " "} | {
    f"{c:X}": bytes([c]).decode("cp1252", "ignore") or chr(c) for c in range(0x80, 0xA0)
}
_BEYOND = "110000"


def _map(pairs: dict[str, str]) -> Column:
    """A constant, whatever its size."""
    return F.str_to_map(F.lit("\x1e".join(f"{k}\x1f{v}" for k, v in pairs.items())), F.lit("\x1e"), F.lit("\x1f"))


def _numbered(digits: Column) -> Column:
    """The character with a number in hex digits; as browsers and Python's
    ``html.unescape`` have it, some numbers stand for others and some for nothing."""
    at = F.conv(digits, 16, 10).cast("int")
    nothing = (
        at.between(1, 8) | (at == 11) | at.between(14, 31) | (at == 127) | at.between(0xFDD0, 0xFDEF)
        | (at.bitwiseAND(0xFFFE) == 0xFFFE)
    )
    # The mark in front tells the order of bytes; without it a number that is one itself would go.
    sign = F.decode(F.unhex(F.concat(F.lit("0000FEFF"), F.lpad(digits, 8, "0"))), "UTF-32")
    return F.coalesce(
        F.try_element_at(_map(_NUMBERS), digits),
        F.when((at > 0x10FFFF) | at.between(0xD800, 0xDFFF), "\ufffd").when(nothing, "").otherwise(sign),
    )


def _referred(after: Column, attribute: bool) -> Column:
    """What follows an ampersand, with the reference that it begins with
    decoded, or with the ampersand if there is none."""
    rest = lambda reference: F.substr(after, F.length(reference) + 1)
    number = F.regexp_extract(after, r"^#(?:[0-9]+|[xX][0-9a-fA-F]+);?", 0)
    decimal = F.regexp_extract(number, "^#0*([0-9]+)", 1)
    hexadecimal = F.upper(F.regexp_extract(number, "^#[xX]0*([0-9a-fA-F]+)", 1))
    digits = F.when(decimal != "", F.when(F.length(decimal) < 8, F.conv(decimal, 10, 16)).otherwise(_BEYOND)).otherwise(
        F.when(F.length(hexadecimal) < 7, hexadecimal).otherwise(_BEYOND)
    )
    # Up to the semicolon, if there is one; what is longer than any name isn't found.
    name = F.concat(F.substring_index(F.left(after, F.lit(max(map(len, _NAMES)))), ";", 1), F.lit(";"))
    # In an address, '&copy=1' is a parameter.
    head = F.left(after, F.lit(_OPEN.index("|") + 1))
    bare = F.regexp_extract(head, f"^(?:{_OPEN})" + ("(?![=A-Za-z0-9])" if attribute else ""), 0)
    named = lambda found: F.concat(F.try_element_at(_map(_NAMES), found), rest(found))
    return F.when(after.startswith("#"), F.concat(_numbered(digits), rest(number))).otherwise(
        F.coalesce(
            F.when(after.contains(";"), named(name)), F.when(bare != "", named(bare)), F.concat(F.lit("&"), after)
        )
    )


def _plain(text: Column, attribute: bool = False) -> Column:
    """The text with all character references decoded, each once."""
    parts = F.split(text, "&(?=#[0-9]|#[xX][0-9a-fA-F]|[A-Za-z][A-Za-z0-9])")
    return F.array_join(F.transform(parts, lambda a, i: F.when(i == 0, a).otherwise(_referred(a, attribute))), "")


def page_text(html: Column) -> Column:
    """The text of a page: hidden parts out, blocks on lines of their own,
    spaces and blank lines collapsed."""
    text = F.regexp_replace(html, _HIDDEN, " ")
    text = F.regexp_replace(text, _BLOCKS, "\n")
    text = _plain(F.regexp_replace(text, _TAGS, ""))
    text = F.regexp_replace(text, r"[ \t\r\f]+", " ")
    text = F.regexp_replace(text, r" ?\n[ \n]*", "\n")
    return F.regexp_replace(text, r"^[ \n]+|[ \n]+$", "")


def responses(pages: DataFrame, date: str = DATE) -> DataFrame:
    """Responses ``page_id, record_id, target_uri, date, headers, payload`` from
    rows ``page_id, url, html``, which have no capture date of their own. Null
    texts count as empty; line ends in an address become spaces; rows that are
    repeated give records that are repeated, with the same identifiers."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    page_id = F.col("page_id").cast("long")
    length = F.octet_length(text("html")).cast("string")
    lines = ("HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8")
    return pages.select(
        page_id.alias("page_id"),
        _record_id(
            F.lit("response"), F.coalesce(page_id.cast("string"), F.lit("")), text("url"), F.sha2(text("html"), 256)
        ).alias("record_id"),
        F.regexp_replace(text("url"), r"[\r\n]+", " ").alias("target_uri"),
        F.lit(date).alias("date"),
        F.concat(F.lit("\r\n".join(lines) + "\r\nContent-Length: "), length).alias("headers"),
        text("html").alias("payload"),
    )


def derived(responses: DataFrame) -> DataFrame:
    """Two records for each response, ``page_id`` and the columns ``RECORD``."""
    found = responses.select(
        "page_id", F.col("record_id").alias("refers_to"), "target_uri", "date", "headers", "payload",
        _digest(F.col("payload")).alias("source_digest"),
        page_text(F.col("payload")).alias("text"),
    )
    lines = F.split("headers", "\r\n")
    headers = F.transform(
        F.filter(F.slice(lines, F.lit(2), F.size(lines)), lambda h: h.contains(":")),
        lambda h: F.struct(
            F.regexp_extract(h, r"^[ \t]*([^:]*?)[ \t]*:", 1).alias("name"),
            F.regexp_extract(h, r"^[^:]*:[ \t]*(.*?)[ \t]*$", 1).alias("value"),
        ),
    )
    title = _plain(F.regexp_replace(F.regexp_extract("payload", _TITLE, 1), r"\s+", " "))
    told = F.to_json(
        F.struct(
            F.substring_index("headers", "\r\n", 1).alias("status"),
            headers.alias("headers"),
            F.trim(title).alias("title"),
            F.transform(
                F.regexp_extract_all("payload", F.lit(_LINK), F.lit(1)),
                lambda x: _plain(F.regexp_replace(x, _QUOTES, ""), True),
            ).alias("links"),
            F.octet_length("payload").alias("payload_length"),
            F.col("source_digest").alias("payload_digest"),
        )
    )
    kinds = F.array(
        F.struct(F.lit("metadata").alias("type"), F.lit("application/json").alias("content_type"), told.alias("block")),
        F.struct(
            F.lit("conversion").alias("type"),
            F.lit("text/plain; charset=utf-8").alias("content_type"),
            F.col("text").alias("block"),
        ),
    )
    return found.withColumn("kind", F.explode(kinds)).select(
        "page_id",
        F.col("kind.type").alias("type"),
        _record_id(F.col("kind.type"), F.col("refers_to")).alias("record_id"),
        "refers_to",
        "target_uri",
        "date",
        F.col("kind.content_type").alias("content_type"),
        F.octet_length("kind.block").cast("long").alias("content_length"),
        _digest(F.col("kind.block")).alias("block_digest"),
        "source_digest",
        F.col("kind.block").alias("block"),
    )


# The field names of the format, by the columns of a record.
_FIELDS = {
    "type": "WARC-Type",
    "record_id": "WARC-Record-ID",
    "refers_to": "WARC-Refers-To",
    "target_uri": "WARC-Target-URI",
    "date": "WARC-Date",
    "content_type": "Content-Type",
    "content_length": "Content-Length",
    "block_digest": "WARC-Block-Digest",
    "source_digest": "WARC-Source-Payload-Digest",
}


def record_text(fields: dict[str, str] = _FIELDS) -> Column:
    """A row as the text of one WARC record."""
    lines = [F.concat(F.lit(f"{name}: "), F.col(c).cast("string")) for c, name in fields.items()]
    return F.concat(F.concat_ws("\r\n", F.lit(VERSION), *lines), F.lit("\r\n\r\n"), F.col("block"), F.lit("\r\n\r\n"))


def write(records: DataFrame, path: str) -> None:
    """Files of records below ``path``, one or more per task."""
    end = "\r\n\r\n"
    whole = F.expr(f"left(record, length(record) - {len(end)})")
    records.select(record_text().alias("record")).select(whole.alias("value")).write.option(
        "lineSep", end
    ).text(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The records of files that ``write`` wrote. A record begins at a version
    line with a type line after it; its length tells how much of what follows
    is its block, so a block may hold anything but that pair of lines."""
    start = f"{VERSION}\r\n{_FIELDS['type']}: "
    rows = spark.read.option("lineSep", start).text(path).where("value <> ''")
    head = F.substring_index("value", "\r\n\r\n", 1)
    field = lambda name: F.regexp_extract(head, rf"(?m)^{name}: ([^\r\n]*)", 1)
    after = F.expr("substring(value, length(substring_index(value, '\\r\\n\\r\\n', 1)) + 5)")
    columns = [F.substring_index(head, "\r\n", 1).alias("type")]
    columns += [field(name).alias(c) for c, name in _FIELDS.items() if c != "type"]
    found = rows.select(*columns, after.alias("after")).withColumn(
        "content_length", F.col("content_length").cast("long")
    )
    block = F.decode(F.substring(F.encode("after", "UTF-8"), F.lit(1), F.col("content_length").cast("int")), "UTF-8")
    return found.withColumn("block", block).select(*RECORD)


def _sql() -> str:
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    listed = lambda values: "[" + ", ".join(map(quote, values)) + "]"
    some = r"&#[0-9]+;?|&#[xX][0-9a-fA-F]+;?|&[A-Za-z][A-Za-z0-9]*[;=]?|[^&]+|&"

    def number(token: str) -> str:
        decimal = f"regexp_extract({token}, '^&#0*([0-9]+)', 1)"
        digits = f"upper(regexp_extract({token}, '^&#[xX]0*([0-9a-fA-F]+)', 1))"
        at = (
            f"case when {decimal} <> '' then case when length({decimal}) < 8 then {decimal}::int else 1114112 end "
            f"when length({digits}) < 7 then ('0x' || {digits})::int else 1114112 end"
        )
        return f"""list_transform([{at}], lambda point: coalesce(numbers[point], case
          when point > 1114111 or point between 55296 and 57343 then chr(65533)
          when point between 1 and 8 or point = 11 or point between 14 and 31 or point = 127
            or point between 64976 and 65007 or point & 65534 = 65534 then '' else chr(point) end))[1]"""

    def name(token: str, attribute: bool) -> str:
        bare = f"regexp_extract({token}, '^&({_OPEN})', 1)"
        alone = f" and regexp_matches({token}, '^&({_OPEN});?$')" if attribute else ""
        return f"""case when {token}[-1] = ';' and names[substr({token}, 2)] is not null then names[substr({token}, 2)]
          when {bare} <> ''{alone} then names[{bare}] || substr({token}, length({bare}) + 2) else {token} end"""

    def plain(text: str, attribute: bool = False) -> str:
        decoded = f"case when x[1] <> '&' then x when x[2] = '#' then {number('x')} else {name('x', attribute)} end"
        return f"array_to_string(list_transform(regexp_extract_all({text}, {quote(some)}), lambda x: {decoded}), '')"

    def record_id(name: str) -> str:
        cuts = ", ".join(f"substr(md5({name}), {a}, {n})" for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))
        return f"'<urn:uuid:' || concat_ws('-', {cuts}) || '>'"

    sub = lambda text, pattern, by: f"regexp_replace({text}, {quote(pattern)}, {by}, 'g')"
    text = sub("payload", _HIDDEN, "' '")
    text = plain(sub(sub(text, _BLOCKS, "chr(10)"), _TAGS, "''"))
    text = sub(sub(sub(text, r"[ \t\r\f]+", "' '"), r" ?\n[ \n]*", "chr(10)"), r"^[ \n]+|[ \n]+$", "''")
    us = "chr(31)"
    points = [int(digits, 16) for digits in _NUMBERS]
    return f"""
with known as (
  select map({listed(_NAMES)}, {listed(_NAMES.values())}) as names,
         map({points}, {listed(_NUMBERS.values())}) as numbers
),
r as (
  select page_id, coalesce(url, '') as url, coalesce(html, '') as payload from pages
),
f as (
  select page_id, payload,
         {record_id(f"'response' || {us} || coalesce(page_id::varchar, '') || {us} || url || {us} || sha256(payload)")} as refers_to,
         {sub("url", "[\\r\\n]+", "' '")} as target_uri, 'sha256:' || sha256(payload) as source_digest,
         octet_length(encode(payload)) as size
  from r
),
k as (
  select f.*, 'metadata' as type, 'application/json' as content_type,
         to_json({{status: 'HTTP/1.1 200 OK',
                  headers: [{{name: 'Content-Type', value: 'text/html; charset=utf-8'}},
                            {{name: 'Content-Length', value: size::varchar}}],
                  title: trim({plain(sub(f"regexp_extract(payload, {quote(_TITLE)}, 1)", r"[ \t\n\x0B\f\r]+", "' '"))}),
                  links: list_transform(regexp_extract_all(payload, {quote(_LINK)}, 1), lambda link: {plain(sub("link", _QUOTES, "''"), True)}),
                  payload_length: size, payload_digest: source_digest}})::varchar as block
  from f, known
  union all
  select f.*, 'conversion', 'text/plain; charset=utf-8', {text} from f, known
)
select page_id, type, {record_id(f"type || {us} || refers_to")} as record_id, refers_to, target_uri,
       '{DATE}' as date, content_type, octet_length(encode(block)) as content_length,
       'sha256:' || sha256(block) as block_digest, source_digest, block
from k
"""


DERIVED_SQL = _sql()
