"""Document fingerprints: a Merkle tree over paragraphs and sections.

Blank lines part sections, line ends part paragraphs. A paragraph's digest is
SHA-256 of its text, a section's that of its paragraphs' digests, the root that
of the sections' digests; so two texts are equal if their roots are. Below each
paragraph hang short hashes of its pieces: sentences, or runs of ``RUN``
characters of a longer sentence. A changed place changes only the pieces,
paragraphs and sections that contain it.

A fingerprint is text: the root, a colon, and the pieces, with commas between
pieces, bars between paragraphs and semicolons between sections. All of this is
built-in functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newslake.llm.common import checkpointed

RUN = 64
_NO_ID = -(1 << 63)
_PIECE = f"[^.!?]{{1,{RUN}}}[.!?]*|[.!?]+"


def fingerprint(text: Column) -> Column:
    """The fingerprint of a text; null for null."""
    sections = lambda: F.split(text, "\n\n")
    digest = lambda parts: F.sha2(F.array_join(parts, ""), 256)
    root = digest(
        F.transform(
            sections(),
            lambda s: digest(F.transform(F.split(s, "\n"), lambda p: F.sha2(p, 256))),
        )
    )
    pieces = lambda p: F.array_join(
        F.transform(
            F.regexp_extract_all(p, F.lit(_PIECE), F.lit(0)), lambda x: F.substring(F.md5(x), 1, 8)
        ),
        ",",
    )
    tree = F.array_join(
        F.transform(sections(), lambda s: F.array_join(F.transform(F.split(s, "\n"), pieces), "|")),
        ";",
    )
    return F.concat(root, F.lit(":"), tree)


def root(fingerprint: Column) -> Column:
    return F.substring(fingerprint, 1, 64)


def _pieces(fingerprint: Column) -> Column:
    return F.array_distinct(F.filter(F.split(F.substring(fingerprint, 66, 1 << 30), "[,|;]"), lambda x: x != ""))


def likeness(left: Column, right: Column) -> Column:
    """From 0 to 1: the shared share of two fingerprints' distinct pieces, 1 if
    their roots are equal, 0 if neither has a piece but the roots differ, null
    for null."""
    a, b = _pieces(left), _pieces(right)
    total = F.size(a) + F.size(b)
    shared = F.when(total > 0, 2.0 * F.size(F.array_intersect(a, b)) / total).otherwise(0.0)
    known = left.isNotNull() & right.isNotNull()
    return F.when(known, F.when(root(left) == root(right), 1.0).otherwise(shared))


def edited_places(old: Column, new: Column) -> Column:
    """Places ``section, paragraph`` (from 0) of the new fingerprint's
    paragraphs that no paragraph of the old one equals; none for equal roots.
    What was deleted, moved or repeated is found by ``differing_places``."""
    known = F.split(F.substring(old, 66, 1 << 30), "[|;]")
    place = F.transform(
        F.split(F.substring(new, 66, 1 << 30), ";"),
        lambda s, i: F.filter(
            F.transform(
                F.split(s, "[|]"),
                lambda p, j: F.struct(
                    i.alias("section"), j.alias("paragraph"), F.array_contains(known, p).alias("known")
                ),
            ),
            lambda x: ~x.known,
        ),
    )
    return F.transform(
        F.flatten(place), lambda x: F.struct(x.section.alias("section"), x.paragraph.alias("paragraph"))
    )


def differing_places(old: Column, new: Column) -> Column:
    """Where the branches of two fingerprints differ: ``old`` and ``new``, lists
    of places ``section, paragraph`` (from 0); at least one is not empty unless
    the trees are equal. Null for null.

    The paragraphs that both begin and end with are left out. If as many are
    left of both, they are compared one by one, otherwise all of them differ. A
    paragraph that begins a section differs from one that doesn't.
    """

    def paragraphs(fingerprint: Column) -> Column:
        branch = lambda p, j: F.concat(F.when(j == 0, ";").otherwise("|"), p)
        return F.flatten(
            F.transform(
                F.split(F.substring(fingerprint, 66, 1 << 30), ";"),
                lambda s, i: F.transform(
                    F.split(s, "[|]"),
                    lambda p, j: F.struct(i.alias("section"), j.alias("paragraph"), branch(p, j).alias("branch")),
                ),
            )
        )

    def alike(a: Column, b: Column) -> Column:
        """How many paragraphs two lists begin with alike."""
        same = F.zip_with(a, b, lambda x, y: x.branch.eqNullSafe(y.branch))
        return F.coalesce(F.nullif(F.array_position(same, F.lit(False)), F.lit(0)) - 1, F.size(same)).cast("int")

    a, b = paragraphs(old), paragraphs(new)
    front = alike(a, b)
    rear = F.least(alike(F.reverse(a), F.reverse(b)), F.size(a) - front, F.size(b) - front)
    left = lambda x: F.slice(x, front + 1, F.size(x) - front - rear)

    def places(of: Column, other: Column) -> Column:
        differs = lambda x, i: (F.size(a) != F.size(b)) | (x.branch != F.get(left(other), i).branch)
        return F.transform(
            F.filter(left(of), differs), lambda x: F.struct(x.section.alias("section"), x.paragraph.alias("paragraph"))
        )

    return F.when(old.isNotNull() & new.isNotNull(), F.struct(places(a, b).alias("old"), places(b, a).alias("new")))


def _next_ids(ids: DataFrame) -> DataFrame:
    """``doc_id, next_id``: the next smaller id, after the smallest the largest.

    Ids are dealt out in ranges, each range finds its own neighbours, and only
    one row per range goes through a single task.
    """
    ranged = ids.repartitionByRange("doc_id").withColumn("range", F.spark_partition_id())
    within = Window.partitionBy("range").orderBy(F.desc("doc_id"))
    inner = checkpointed(  # stored, so that the ranges are the same wherever they are used
        ranged.select("doc_id", "range", F.lead("doc_id").over(within).alias("next_id"))
    )
    ranges = inner.groupBy("range").agg(F.max("doc_id").alias("largest"))
    over = Window.orderBy(F.desc("range"))
    first = F.first("largest").over(over.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    follow = ranges.select("range", F.coalesce(F.lead("largest").over(over), first).alias("follow"))
    return inner.join(F.broadcast(follow), "range").select(
        "doc_id", F.coalesce("next_id", "follow").alias("next_id")
    )


def compared(docs: DataFrame) -> DataFrame:
    """Every text beside an edited one and the next document.

    The edited text has its last third (of code points, rounded down) replaced
    by the first as many code points of the next document, in descending order
    of ``doc_id``; after the last comes the first. Null texts count as empty.
    Rows that repeat a ``doc_id`` each have a result; as a next document, one of
    them counts, the one whose head and fingerprint sort first. Rows without a
    ``doc_id`` have no next document: nothing replaces the last third, and
    ``near_next`` is null.
    """
    doc_id = F.col("doc_id").cast("long")
    # The key is never null, so both joins below use one shuffle of the texts.
    texts = docs.select(
        doc_id.alias("doc_id"),
        F.coalesce(doc_id, F.lit(_NO_ID)).alias("doc_key"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    lengths = texts.where("doc_id is not null").groupBy("doc_id").agg(
        F.max(F.length("text")).alias("n")
    )
    wanted = lengths.join(_next_ids(lengths.select("doc_id")), "doc_id").select(
        F.col("next_id").alias("doc_key"),
        F.col("doc_id").alias("asker"),
        F.expr("n div 3").cast("int").alias("wanted"),
    )
    following = (
        texts.join(wanted.hint("shuffle_hash"), "doc_key")
        .select(
            F.col("asker").alias("doc_key"),
            "doc_id",
            F.struct(
                F.expr("left(text, wanted)").alias("head"),
                fingerprint(F.col("text")).alias("fingerprint"),
            ).alias("next"),
        )
        .groupBy("doc_key").agg(F.min(F.when(F.col("doc_id").isNotNull(), F.col("next"))).alias("next"))
    )
    third = "(length(text) div 3)"
    both = texts.join(following, "doc_key", "left").select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        fingerprint(F.col("text")).alias("fingerprint"),
        F.expr(
            f"concat(left(text, int(length(text) - {third})), coalesce(left(next.head, int{third}), ''))"
        ).alias("edited"),
        F.col("next.fingerprint").alias("next_fingerprint"),
    )
    return both.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        "fingerprint",
        fingerprint(F.col("edited")).alias("edited_fingerprint"),
        "next_fingerprint",
    ).select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )


COMPARED_SQL = f"""
with d as (select doc_id, coalesce(text, '') as text, length(coalesce(text, '')) as n from documents),
n as (
  select *, coalesce(lead(text) over (order by doc_id desc),
                     first_value(text) over (order by doc_id desc)) as next_text
  from d
),
e as (
  select *, left(text, n - n // 3) || left(next_text, n // 3) as edited from n
),
t as (
  select doc_id, unnest([1, 2, 3]) as which, unnest([text, edited, next_text]) as text from e
),
f as (
  select doc_id, which,
         sha256(array_to_string(list_transform(string_split(text, e'\\n\\n'), lambda s:
           sha256(array_to_string(list_transform(string_split(s, e'\\n'), lambda p: sha256(p)), ''))), ''))
         as root,
         list_transform(string_split(text, e'\\n\\n'), lambda s:
           list_transform(string_split(s, e'\\n'), lambda p:
             list_transform(regexp_extract_all(p, '{_PIECE.replace("[^.!?]", "(?s:[^.!?])")}'), lambda x: substr(md5(x), 1, 8))))
         as tree
  from t
),
g as (
  select doc_id, which, root, list_distinct(flatten(flatten(tree))) as pieces,
         root || ':' || array_to_string(list_transform(tree, lambda s:
           array_to_string(list_transform(s, lambda p: coalesce(array_to_string(p, ','), '')), '|')), ';')
         as fingerprint
  from f
)
select e.doc_id, e.n as n_chars, sha256(e.edited) as edited_sha256, a.fingerprint,
       b.fingerprint as edited_fingerprint,
       case when a.root = b.root then 1.0
            when len(a.pieces) + len(b.pieces) = 0 then 0.0
            else 2.0 * len(list_intersect(a.pieces, b.pieces)) / (len(a.pieces) + len(b.pieces))
       end::double as near_edited,
       case when a.root = c.root then 1.0
            when len(a.pieces) + len(c.pieces) = 0 then 0.0
            else 2.0 * len(list_intersect(a.pieces, c.pieces)) / (len(a.pieces) + len(c.pieces))
       end::double as near_next
from e join g a on a.doc_id = e.doc_id and a.which = 1
       join g b on b.doc_id = e.doc_id and b.which = 2
       join g c on c.doc_id = e.doc_id and c.which = 3
"""
