"""Column expressions for cleaning, naming, display and prompts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: stands for a missing name.
UNKNOWN = "Unknown"

# Characters of a title that change in an object name; those
# without a counterpart in the second string are deleted.
SLUG_FROM, SLUG_TO = "/ :',?!", "-_-"
SLUG_CHARS = 50
# Place and name of landed objects, and what is shown of texts.
OBJECT_PREFIX = "bronze/news/"
OBJECT_TIME = "yyyy/MM/dd/HHmmss"
URL_TAG_CHARS = 500
PREVIEW_CHARS = 60

# Wording of the context block and the prompt.
CONTEXT_BLOCK = (
    "\nArticle %d:\nTitle: %s\nSource: %s\nPublished: %s\nDescription: %s\nURL: %s\n"
)
PROMPT_HEAD = (
    "You are a helpful news assistant. Using the news articles provided below,\n"
    "answer the user's question accurately and concisely.\n"
    "If the articles don't contain enough information, say so honestly.\n"
    "Always mention which sources you used in your answer.\n"
    "\n"
    "News Articles:\n"
)
PROMPT_QUESTION = "\n\nQuestion: "
PROMPT_TAIL = "\n\nAnswer:"
NO_ARTICLES = "No relevant articles found."


def or_unknown(c: Column) -> Column:
    """Null becomes ``Unknown``; anything else, blanks included, is trimmed."""
    return F.coalesce(F.trim(c), F.lit(UNKNOWN))


def title_slug(title: Column) -> Column:
    return F.translate(F.substring(title, 1, SLUG_CHARS), SLUG_FROM, SLUG_TO)


def utc(ts: Column) -> Column:
    """Wall-clock time in UTC, whatever the session's zone."""
    return F.to_utc_timestamp(ts, F.current_timezone())


def object_key(title: Column, arrived: Column) -> Column:
    return F.concat(
        F.lit(OBJECT_PREFIX), F.date_format(utc(arrived), OBJECT_TIME), F.lit("_"),
        title_slug(title), F.lit(".json"),
    )


def url_tag(url: Column) -> Column:
    return F.substring(url, 1, URL_TAG_CHARS)


def preview(title: Column) -> Column:
    return F.substring(title, 1, PREVIEW_CHARS)


def iso_text(ts: Column) -> Column:
    """ISO-8601 text in UTC, with microseconds only where there are any."""
    fraction = F.date_format(utc(ts), ".SSSSSS")
    return F.concat(
        F.date_format(utc(ts), "yyyy-MM-dd'T'HH:mm:ss"),
        F.when(fraction == ".000000", "").otherwise(fraction),
        F.lit("+00:00"),
    )


def embedding_text(title: Column, description: Column, content: Column) -> Column:
    """Labelled parts joined by one space; null or empty parts are left out."""

    def part(label: str, c: Column) -> Column:
        return F.when(c != "", F.concat(F.lit(f"{label}: "), c))

    return F.concat_ws(
        " ", part("Title", title), part("Description", description), part("Content", content)
    )


def context_block(rank: Column, meta: Column) -> Column:
    def field(name: str) -> Column:
        return F.coalesce(meta[name], F.lit(""))

    return F.format_string(
        CONTEXT_BLOCK, rank, field("title"), field("source"), field("published_at"),
        field("description"), field("url"),
    )


def prompt(context: Column, question: Column) -> Column:
    return F.concat(
        F.lit(PROMPT_HEAD), context, F.lit(PROMPT_QUESTION), question, F.lit(PROMPT_TAIL)
    )


def source_link(title: Column, url: Column, source: Column) -> Column:
    parts = (F.coalesce(c, F.lit("")) for c in (title, url, source))
    return F.format_string("- [%s](%s) — **%s**", *parts)
