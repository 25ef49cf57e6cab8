"""License scans by diagonal voting.

Templates are short texts with a label. All rolling k-grams of all documents'
words are joined, by hash, to the places where templates have them; the words
themselves are compared as well. A match votes for a diagonal: place in the
document minus place in the template. Votes are gathered per document, template
and diagonal as bit masks of template places, one per ``BITS`` words of the
longest template, which Spark combines before the shuffle. Neighbouring diagonals, which words put in or left out leave behind,
are merged to spans; chains of them that run on, as in lists, are taken in
pieces. A span is verified if enough of its template's words stand
in it, and a phrase is found in full where one diagonal covers all of it.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

K = 2
BITS = 60
MOST_GRAMS = 100_000
SHARE = 0.8
GAP = 3

# The phrases that are counted, with their labels.
PHRASES = (
    ("gpl", "gnu general public license"),
    ("apache", "apache license"),
    ("cc-by", "cc by"),
    ("mit", "mit license"),
)

#: Notices that are recognised even if some words differ, with their labels.
NOTICES = (
    ("apache", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"),
    ("apache", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis"),
    ("apache-2.0", "apache license version 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("cc-by", "this work is licensed under a creative commons attribution international license"),
    ("cc-by-nc", "cc by nc"),
    ("cc-by-sa", "cc by sa"),
    ("cc-by-nd", "cc by nd"),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("gpl-3", "gnu general public license version 3"),
    ("lgpl", "gnu lesser general public license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license"),
    ("apache-2.0", "apache 2 0"),
    ("bsd", "bsd 2 clause"),
    ("bsd", "bsd 3 clause"),
    ("gpl", "gnu gpl"),
    ("gpl-3", "gnu gpl v3"),
    ("gpl-3", "gnu gpl version 3"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("mit", "spdx license identifier mit"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software"),
    ("mpl", "mozilla public license"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
)

_BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words in lower case. The Kelvin sign is set aside first: of all letters
    beyond ASCII, it alone has an ASCII letter as its lower case."""
    lower = F.lower(F.replace(text, F.lit("\u212a"), F.lit("\u0138")))
    return F.array_remove(F.split(lower, _BREAKS), "")


def _templates(
    spark: SparkSession,
    phrases: Sequence[tuple[str, str]],
    notices: Sequence[tuple[str, str]],
) -> list[DataFrame]:
    """One row per k-gram of a template: ``template, label, base, n_grams,
    at, gram, gram_words``. A template needs ``K`` words and may have any number.
    No table has more than ``MOST_GRAMS`` rows, so each can be broadcast."""
    rows = []
    for number, (base, (label, text)) in enumerate(
        [(True, p) for p in phrases] + [(False, n) for n in notices]
    ):
        split = text.split()
        if len(split) < K:
            raise ValueError(f"a template needs {K} words: {text!r}")
        grams = [split[i : i + K] for i in range(len(split) - K + 1)]
        rows += [(number, label, base, len(grams), i, g) for i, g in enumerate(grams)]
    schema = "template int, label string, base boolean, n_grams int, at int, gram_words array<string>"
    gram = F.xxhash64(*(F.get("gram_words", i) for i in range(K)))
    return [
        spark.createDataFrame(rows[i : i + MOST_GRAMS], schema).withColumn("gram", gram)
        for i in range(0, max(1, len(rows)), MOST_GRAMS)
    ]


def votes(docs: DataFrame, templates: Sequence[DataFrame], longest: int) -> DataFrame:
    """``doc_key, row_key, template, label, base, n_grams, diagonal, low, high,
    mask_0, mask_1...``: the template places that agree on each diagonal, the
    lowest, the highest, and all as bits; ``longest`` is the number of words of
    the longest template. Each table of templates is sent to all tasks, so only
    votes are shuffled."""
    split = docs.select("doc_key", "row_key", words(F.col("text")).alias("words"))
    grams = F.when(
        F.size("words") >= K,
        F.transform(
            F.sequence(F.lit(0), F.size("words") - K),
            lambda i: F.xxhash64(*(F.get("words", i + j) for j in range(K))),
        ),
    )
    rolled = split.select("doc_key", "row_key", "words", F.posexplode(grams).alias("place", "gram"))
    same = F.lit(True)
    for j in range(K):
        same = same & (F.get("words", F.col("place") + j) == F.get("gram_words", F.lit(j)))
    template = ["template", "label", "base", "n_grams"]
    matched = [
        rolled.join(F.broadcast(part), "gram").where(same).select(
            "doc_key", "row_key", *template, (F.col("place") - F.col("at")).alias("diagonal"),
            "at", F.expr(f"shiftleft(1L, at % {BITS})").alias("bit"),
        )
        for part in templates
    ]
    return (
        reduce(DataFrame.union, matched)
        .groupBy("doc_key", "row_key", *template, "diagonal")
        .agg(
            F.min("at").alias("low"), F.max("at").alias("high"),
            *(
                F.coalesce(F.bit_or(F.when(F.floor(F.col("at") / BITS) == b, F.col("bit"))), F.lit(0)).alias(f"mask_{b}")
                for b in range(-(-longest // BITS))
            ),
        )
    )


def _covered(block: int) -> Column:
    """The words of a block of the template that agreeing places cover: their
    own, and those that they reach from the block before."""
    own, full = f"mask_{block}", (1 << BITS) - 1
    reached = "".join(f" | (shiftleft({own}, {j}) & {full}L)" for j in range(1, K))
    if block:
        reached += "".join(f" | shiftright(mask_{block - 1}, {BITS - j})" for j in range(1, K))
    return F.expr(own + reached)


def spans(votes: DataFrame) -> DataFrame:
    """Verified spans of templates: ``doc_key, row_key, label, base, first_word,
    last_word, score``; ``score`` is the share of the template's words in it.

    Diagonals of a document and template, of which there are no more than the
    two have words, are merged if they lie at most ``GAP`` apart. Those of
    base phrases stay alone, and count only if they have the phrase whole. A
    chain that covers more words than the template and ``GAP`` is taken in
    pieces: from where each of its diagonals starts, as many words as that, with
    that diagonal and the chain of those around it that lie in them whole.
    Chains whose diagonals together cover too few words are set aside before.
    """
    key = ["doc_key", "row_key", "template", "label", "base", "n_grams"]
    blocks = range(sum(c.startswith("mask_") for c in votes.columns))
    n_covered = reduce(Column.__add__, (F.bit_count(F.col("covered")[b]) for b in blocks))
    n_words = F.col("n_grams") + K - 1
    by = Window.partitionBy("doc_key", "row_key", "template").orderBy("diagonal")
    near = F.col("diagonal") - F.lag("diagonal").over(by) <= GAP
    of_chain = Window.partitionBy("doc_key", "row_key", "template", "chain")
    # Two diagonals with places in the same piece are no further apart.
    apart = 2 * BITS * len(blocks) + GAP
    around = of_chain.orderBy("diagonal").rangeBetween(-apart, apart)
    most = n_words + GAP
    is_long = ~F.col("base") & (F.max("end").over(of_chain) - F.min("start").over(of_chain) >= most)
    inside = F.filter("around", lambda d: (d.start >= F.col("start")) & (d.end - F.col("start") < most))

    def joined(piece: Column, diagonals: Column) -> Column:
        """The piece with the diagonals, nearest first, as far as they chain."""
        own = F.struct(F.col("diagonal").alias("last"), piece.end.alias("end"), piece.covered.alias("covered"))
        return F.aggregate(
            diagonals,
            own,
            lambda got, d: F.when(
                F.abs(d.diagonal - got["last"]) <= GAP,
                F.struct(
                    d.diagonal.alias("last"), F.greatest(got.end, d.end).alias("end"),
                    F.zip_with(got.covered, d.covered, Column.bitwiseOR).alias("covered"),
                ),
            ).otherwise(got),
        )

    after = joined(F.struct("end", "covered"), F.filter("inside", lambda d: d.diagonal > F.col("diagonal")))
    before = F.reverse(F.filter("inside", lambda d: d.diagonal < F.col("diagonal")))
    merged = (
        votes.withColumns({
            "covered": F.array(*map(_covered, blocks)),
            "start": F.col("diagonal") + F.col("low"),
            "end": F.col("diagonal") + F.col("high") + K - 1,
            "alone": F.when(F.col("base") | near.isNull() | ~near, 1).otherwise(0),
        })
        .withColumn("chain", F.sum("alone").over(by))
        .withColumn("hope", F.sum(n_covered).over(of_chain) >= n_words * SHARE)
        .where("hope")
        .withColumn("long", is_long)
        .withColumn("around", F.collect_list(F.when(F.col("long"), F.struct("diagonal", "start", "end", "covered"))).over(around))
        .withColumn("inside", F.when(F.col("long"), inside))
        .withColumn("after", F.when(F.col("long"), after))
        .withColumn("piece", F.when(F.col("long"), joined(F.col("after"), before)))
        .withColumns({
            "part": F.when(F.col("long"), F.col("diagonal")),
            "end": F.coalesce("piece.end", "end"),
            "covered": F.coalesce("piece.covered", "covered"),
        })
        .groupBy(*key, "chain", "part")
        .agg(
            F.min("start").alias("first_word"), F.max("end").alias("last_word"),
            F.array(*(F.bit_or(F.col("covered")[b]) for b in blocks)).alias("covered"),
        )
        .withColumn("score", (n_covered / n_words).cast("double"))
    )
    verified = F.when(F.col("base"), F.col("score") == 1).otherwise(F.col("score") >= SHARE)
    return merged.where(verified).select(
        "doc_key", "row_key", "label", "base", "first_word", "last_word", "score"
    )


def scanned(
    docs: DataFrame,
    phrases: Sequence[tuple[str, str]] = PHRASES,
    notices: Sequence[tuple[str, str]] = NOTICES,
) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_base, first_word, last_word,
    base_labels, labels, score``.

    ``n_base`` counts all places of phrases, ``first_word`` and ``last_word``
    are the smallest and largest word at which one begins, null without any.
    Labels are distinct, sorted and joined by commas; ``score`` is that of the
    best span, 0 without one. Null texts count as empty. Rows that repeat a
    ``doc_id`` have results of their own. Other columns are ignored.
    """
    doc_id = F.col("doc_id").cast("long")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    texts = docs.select(
        doc_id.alias("doc_id"), F.coalesce(doc_id, F.lit(-(1 << 63))).alias("doc_key"),
        F.xxhash64(doc_id, text).alias("row_key"), text.alias("text"),
    )
    longest = max((len(t.split()) for _, t in [*phrases, *notices]), default=1)
    found = spans(votes(texts, _templates(docs.sparkSession, phrases, notices), longest))
    base_start = F.when(F.col("base"), F.col("first_word"))
    labels = lambda of: F.array_join(F.array_sort(F.collect_set(of)), ",")
    per_doc = found.groupBy("doc_key", "row_key").agg(
        F.count(base_start).alias("n_base"),
        F.min(base_start).cast("long").alias("first_word"),
        F.max(base_start).cast("long").alias("last_word"),
        labels(F.when(F.col("base"), F.col("label"))).alias("base_labels"),
        labels(F.col("label")).alias("labels"),
        F.max("score").alias("score"),
    )
    counted = texts.select("doc_id", "doc_key", "row_key", F.size(words(F.col("text"))).cast("long").alias("n_words"))
    none = {"n_base": 0, "base_labels": "", "labels": "", "score": 0.0}
    return counted.join(per_doc, ["doc_key", "row_key"], "left").fillna(none).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"
    )


def _sql() -> str:
    rows = ", ".join(
        f"({number}, '{label}', {base}, '{text}')"
        for number, (base, (label, text)) in enumerate(
            [("true", p) for p in PHRASES] + [("false", n) for n in NOTICES]
        )
    )
    upper = "".join(map(chr, range(65, 91)))
    return f"""
with t0(template, label, base, text) as (values {rows}),
t as (select *, string_split(text, ' ') as tw from t0),
g as (
  select template, label, base, len(tw) as n, unnest(range(len(tw) - 1)) as pos, tw from t
),
d as (
  select doc_id,
         list_filter(string_split_regex(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'),
                     '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') as w
  from documents
),
r as (select doc_id, unnest(range(len(w) - 1)) as place, w from d),
b as (select doc_id, place, w[place + 1] as a, w[place + 2] as b from r),
v as (
  select doc_id, template, label, base, n, place - pos as diagonal,
         min(place) as first, max(place) + 1 as last, list(pos) as spots
  from b join g on b.a = g.tw[pos + 1] and b.b = g.tw[pos + 2]
  group by all
),
c as (
  select *, sum(apart) over (partition by doc_id, template order by diagonal) as chain
  from (
    select *, case when diagonal - lag(diagonal) over (partition by doc_id, template order by diagonal) <= {GAP}
                   then 0 else 1 end as apart
    from v where not base
  )
),
m as (
  select doc_id, template, label, n, chain, min(first) as first, max(last) as last, flatten(list(spots)) as spots
  from c group by all
),
i as (
  select o.doc_id, o.template, o.label, o.n, o.diagonal as of, d.diagonal, d.spots
  from c o join m using (doc_id, template, chain) join c d using (doc_id, template, chain)
  where m.last - m.first >= o.n + {GAP} and d.first >= o.first and d.last - o.first < o.n + {GAP}
),
j as (
  select *, sum(apart) over (partition by doc_id, template, of order by diagonal) as run
  from (
    select *, case when diagonal - lag(diagonal) over (partition by doc_id, template, of order by diagonal) <= {GAP}
                   then 0 else 1 end as apart
    from i
  )
),
k as (
  select *, max(run) filter (diagonal = of) over (partition by doc_id, template, of) as own from j
),
q as (
  select doc_id, template, label, n, spots from m where last - first < n + {GAP}
  union all
  select doc_id, template, label, n, flatten(list(spots)) from k where run = own
  group by doc_id, template, label, n, of
),
s as (
  select doc_id, label, base, diagonal as first_word, 1.0::double as score
  from v where base and len(list_distinct(spots)) = n - 1
  union all
  select doc_id, label, false, null, score
  from (
    select doc_id, label,
           len(list_distinct(spots || list_transform(spots, lambda x: x + 1))) / n::double as score
    from q
  )
  where score >= {SHARE}
),
p as (
  select doc_id, count(*) filter (base) as n_base, min(first_word) filter (base) as first_word,
         max(first_word) filter (base) as last_word,
         string_agg(distinct label, ',' order by label) filter (base) as base_labels,
         string_agg(distinct label, ',' order by label) as labels, max(score) as score
  from s group by doc_id
)
select d.doc_id, len(w) as n_words, coalesce(n_base, 0) as n_base, first_word, last_word,
       coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels,
       coalesce(score, 0) as score
from d left join p using (doc_id)
"""


SCANNED_SQL = _sql()
