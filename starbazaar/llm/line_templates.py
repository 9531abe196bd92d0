"""Line dedup by a log-template tree of fixed depth; DataFrame functions only.

A line's words with a digit or an at sign are variable fields, which gives its form. The tree's path is the number of words and the first
``DEPTH`` words. The forms of a leaf go by their number of documents, then by their earliest document and line: a form that differs in at most
one word of ``SLACK`` from the lead of a template joins that template, what differs being another variable field (the first such lead, if there
are several); any other form leads a template of its own. A template in two documents or more recurs: the document with the smallest id
keeps its lines, all others lose them.

No large leaf is gone through form by form. Two forms with few differing words agree in a place that can be looked up: in a short line with one word
left out, in a longer one in one of as many runs of words as may differ, and one more. Forms that share such a place and nothing else are
in one bucket. In each round the forms that come first in all their buckets are leads, and the forms of these buckets are compared with
them, word by word; the rest goes on. Pairs of forms are never made, and a family of very many forms needs one lead and one round.
Many unlike forms with a common place would need a round each, so what a round leaves of a leaf is gone through at once if that is little
(``WALK``).

Forms are counted before anything is compared, so a line of a third of all rows is one row by then.

Defined results: lines of fewer than ``LEAST`` words never go; a repeat within one document stays; null stays null, an empty text
empty; rows without doc_id count as one document after all others; rows that share a doc_id are one document; a document whose
lines all go keeps its row with an empty text; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starbazaar.llm.common import WORD, likely, own_column, table, written
from starbazaar.operators.numbering import with_position

#: Of so many words one may differ.
DEPTH, LEAST, SLACK = 3, 4, 5
#: Forms of a leaf times all their words, up to which what is left of it is gone through in one task.
WALK = 1 << 26
_LAST = (1 << 63) - 1
#: A word with a digit or an at sign; looked for at the begin of a word only.
_FIELD = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+"


def _parsed(line: Column) -> Column:
    masked = F.when(line.rlike("[0-9@]"), F.regexp_replace(line, _FIELD, "<*>")).otherwise(line)
    return F.regexp_extract_all(masked, F.lit(WORD), F.lit(0))


def _document() -> Column:
    return F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_LAST))


def _lines(docs: DataFrame) -> DataFrame:
    """One row per line that is long enough, with the hashes of its leaf and form."""
    # Parsed before they become rows: a condition on the words would otherwise have each line parsed twice.
    exploded = docs.select(
        _document().alias("doc"), F.xxhash64("text").alias("tag"),
        F.posexplode(F.transform(F.split("text", "\n"), _parsed)).alias("pos", "words"))
    return exploded.withColumn("n", F.size("words")).where(F.col("n") >= LEAST).select(
        "doc", "tag", "pos", "n", F.xxhash64("n", F.slice("words", 1, DEPTH)).alias("leaf"), F.xxhash64("words").alias("form"))


def _crowded(docs: DataFrame, forms: DataFrame) -> DataFrame:
    """form, n, rank and rest (hashes of the words below the leaf) of the forms that are not alone in their leaf and have words to spare."""
    full = forms.where(F.col("n") >= SLACK).groupBy("leaf").agg(F.count("*").alias("forms")).where("forms > 1").select("leaf")
    # A dense number for the order, which is cheaper to compare than what it stands for.
    own = written(with_position(forms.join(full, "leaf", "left_semi").select(
        "form", "n", (-F.col("docs")).alias("seldom"), "at.*"), ["seldom", "doc", "pos", "form"], "rank", "form-order").drop("seldom"), "crowded-forms")
    # The words come from the texts again, from the line that stands for the form: the text meets all its forms at once, and no others go along.
    asked = own.groupBy("doc", "tag").agg(F.collect_list(F.struct("pos", "form", "n", "rank")).alias("asked"))
    texts = likely(docs.select(_document().alias("doc"), F.xxhash64("text").alias("tag"), "text"), F.xxhash64("doc", "tag"),
                   own.select(F.xxhash64("doc", "tag").alias("text_hash"))).where("likely")
    # A text is split once for all its forms.
    picked = F.transform(F.array(F.split("text", "\n")), lambda parts: F.transform("asked", lambda x: F.struct(
        x["form"].alias("form"), x["n"].alias("n"), x["rank"].alias("rank"), F.get(parts, x["pos"]).alias("line"))))
    lines = texts.join(asked, ["doc", "tag"]).select(F.explode(F.flatten(picked)).alias("own")).select("own.*", _parsed(F.col("own.line")).alias("words"))
    return written(lines.select(
        "form", "n", "rank", F.transform(F.slice("words", F.lit(DEPTH + 1), F.size("words")), lambda w: F.xxhash64(w)).alias("rest"),
        F.xxhash64("n", F.slice("words", 1, DEPTH)).alias("leaf")).dropDuplicates(["form"]), "crowded-words")  # repeated rows have equal lines


def _places() -> Column:
    """The places in which a form is looked up."""
    rest, leaf, size = F.col("rest"), F.col("leaf"), F.size("rest")
    slack = F.floor(F.col("n") / SLACK)
    without = F.transform(F.sequence(F.lit(0), size - 1), lambda i: F.xxhash64(
        F.lit("without"), leaf, i, F.concat(F.slice(rest, F.lit(1), i), F.slice(rest, i + 2, size))))

    def run(j: Column) -> Column:
        begin, end = F.floor(size * j / (slack + 1)), F.floor(size * (j + 1) / (slack + 1))
        return F.xxhash64(F.lit("run"), leaf, j, F.slice(rest, (begin + 1).cast("int"), (end - begin).cast("int")))

    runs = F.transform(F.sequence(F.lit(0).cast("bigint"), slack), run)
    return F.when(slack == 1, without).otherwise(runs)


def _differing(one: Column, other: Column) -> Column:
    return F.size(F.filter(F.zip_with(one, other, lambda a, b: a != b), lambda x: x))


def _walked(words: DataFrame) -> DataFrame:
    """form, lead and lead_rank from going through each leaf in order; of a decided form only whether one of these leads would come before its own."""
    leads = "array<struct<form:bigint,rank:bigint,rest:array<bigint>>>"
    links = "array<struct<form:bigint,lead:bigint,lead_rank:bigint>>"

    def step(so_far: Column, x: Column) -> Column:
        met = F.get(F.filter(so_far["leads"], lambda lead: _differing(x["rest"], lead["rest"]) * SLACK <= x["n"]), F.lit(0))
        own = F.struct(x["form"].alias("form"), x["rank"].alias("rank"), x["rest"].alias("rest"))
        new = met.isNull() & x["undecided"]
        of = F.when(new, own).otherwise(met)
        link = F.struct(x["form"].alias("form"), of["form"].alias("lead"), of["rank"].alias("lead_rank"))
        return F.struct(
            F.when(new, F.concat(so_far["leads"], F.array(own))).otherwise(so_far["leads"]).cast(leads).alias("leads"),
            F.when(of.isNull(), so_far["links"]).otherwise(F.concat(so_far["links"], F.array(link))).cast(links).alias("links"))

    ordered = words.groupBy("leaf").agg(F.sort_array(F.collect_list(F.struct("rank", "form", "n", "undecided", "rest"))).alias("forms"))
    none = F.struct(F.array().cast(leads).alias("leads"), F.array().cast(links).alias("links"))
    return ordered.select(F.explode(F.aggregate("forms", none, step, lambda so_far: so_far["links"])).alias("link")).select("link.*")


def _joined(crowded: DataFrame) -> DataFrame:
    """form and lead of every form that joins another one's template; a lead of a template has itself, unless it is alone in all its places."""
    placed = crowded.select("form", "rank", F.explode(_places()).alias("place"))
    shared = placed.groupBy("place").agg(F.count("*").alias("n")).where("n > 1").select("place")
    # Of a form alone in all its places nothing is to be decided.
    buckets = written(placed.join(shared, "place", "left_semi").withColumn("undecided", F.lit(True)), "line-buckets")
    words = crowded.select("form", "n", "leaf", "rest")
    found = None
    while not buckets.isEmpty():
        undecided = buckets.where("undecided")
        firsts = undecided.groupBy("place").agg(F.min("rank").alias("first"))
        leads = undecided.join(firsts, "place").groupBy("form", "rank").agg(
            F.min(F.col("rank") == F.col("first")).alias("lead")).where("lead").select(F.col("form").alias("lead"), F.col("rank").alias("lead_rank"))
        # At most one lead a place: the first one there. It meets itself, so that one table tells all that is decided.
        at = undecided.join(leads, F.col("form") == F.col("lead")).select("place", "lead", "lead_rank")
        pairs = buckets.join(at, "place").where(F.col("rank") >= F.col("lead_rank")).select("form", "lead", "lead_rank").distinct()
        both = pairs.join(words.select("form", "n", "rest"), "form").join(words.select(F.col("form").alias("lead"), F.col("rest").alias("lead_rest")), "lead")
        links = written(both.where(_differing(F.col("rest"), F.col("lead_rest")) * SLACK <= F.col("n")).select("form", "lead", "lead_rank"), "line-links")
        found = links if found is None else found.unionByName(links)
        decided = links.select("form", F.lit(True).alias("decided")).distinct()
        # Only places that still hold an undecided form go on, and the words of the forms there.
        held = undecided.join(decided, "form", "left_anti").select("place").distinct()
        buckets = written(buckets.join(held, "place", "left_semi").join(decided, "form", "left").select(
            "place", "form", "rank", (F.col("undecided") & F.col("decided").isNull()).alias("undecided")), "line-buckets")
        forms = buckets.select("form", "rank", "undecided").distinct()
        words = written(words.drop("rank", "undecided").join(forms, "form"), "line-words")
        if words.isEmpty():
            break
        # Forms of one leaf can agree only with each other, and those that can all share a place that is still held.
        large = F.count("*") * F.sum(F.size("rest").cast("bigint")) > WALK
        leaves = words.groupBy("leaf").agg(large.alias("large"))
        found = found.unionByName(written(_walked(words.join(leaves.where("not large"), "leaf", "left_semi")), "line-walks"))
        words = words.join(leaves.where("large"), "leaf", "left_semi")
        buckets = buckets.join(words.select("form"), "form", "left_semi")
    if found is None:
        return crowded.select("form", F.col("form").alias("lead")).limit(0)
    return found.groupBy("form").agg(F.min_by("lead", "lead_rank").alias("lead"))


def recurring(docs: DataFrame, lines: DataFrame) -> DataFrame:
    """form and the document that keeps it, of every form whose template is in two documents or more."""
    seen = lines.groupBy("leaf", "n", "form", "doc").agg(F.min(F.struct("pos", "tag")).alias("at"))
    forms = written(seen.groupBy("leaf", "n", "form").agg(
        F.count("*").alias("docs"), F.min("doc").alias("first"), F.max("doc").alias("last"),
        F.min(F.struct("doc", F.col("at.pos").alias("pos"), F.col("at.tag").alias("tag"))).alias("at")), "line-forms")
    joined = _joined(_crowded(docs, forms))
    of = forms.join(joined, "form", "left").select("form", "first", "last", F.coalesce("lead", "form").alias("template"))
    both = of.groupBy("template").agg(F.min("first").alias("keeper"), F.max("last").alias("other")).where("keeper < other")
    return of.select("form", "template").join(both, "template").select("form", "keeper")


def without_recurring(docs: DataFrame) -> DataFrame:
    """``docs`` with the recurring lines gone from ``text``, and the numbers of lines before and dropped in two more columns, the last.

    A column ``n_chars`` of whole numbers, if there, gives the new length.
    """
    texts = docs.select("doc_id", "text")
    lines = written(_lines(texts), "lines")
    kept = written(recurring(texts, lines), "line-templates")
    gone = lines.join(kept, "form").where("doc <> keeper").groupBy("doc", "tag").agg(F.collect_set("pos").alias("gone"))
    doc, tag, drop, parts, before, after = (own_column(docs, c) for c in ("line_doc", "line_tag", "line_gone", "line_parts", "n_lines", "n_dropped"))
    gone = gone.select(F.col("doc").alias(doc), F.col("tag").alias(tag), F.col("gone").alias(drop))
    # Texts that lose nothing stay where they are.
    split = likely(docs, F.xxhash64(_document(), F.xxhash64("text")), gone.select(F.xxhash64(doc, tag).alias("text_hash")))
    may = split.columns[-1]
    whole, cut = (split.where(rows).drop(may) for rows in (~F.col(may), F.col(may)))
    marked = cut.join(gone, (_document() == F.col(doc)) & (F.xxhash64("text") == F.col(tag)), "left").unionByName(whole, allowMissingColumns=True)
    size = F.coalesce(F.size(parts), F.lit(0))
    stay = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col(drop))
    text = F.when(F.col(drop).isNull(), F.col("text")).otherwise(F.array_join(F.transform(stay, lambda i: F.get(F.col(parts), i)), "\n"))
    cleaned = marked.withColumn(parts, F.split("text", "\n")).withColumns({
        "text": text, before: F.when(F.col("text").isNull(), 0).otherwise(size).cast("bigint"),
        after: F.when(F.col(drop).isNull(), 0).otherwise(F.size(drop)).cast("bigint")})
    counted = next((f for f in docs.schema if f.name == "n_chars" and isinstance(f.dataType, T.IntegralType)), None)
    if counted is not None:
        cleaned = cleaned.withColumn("n_chars", F.coalesce(F.length("text").cast(counted.dataType), F.col("n_chars")))
    return cleaned.select(*docs.columns, before, after)


def op3_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_recurring(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_lines", "n_dropped", "text")


ORACLE_SQL = f"""
WITH RECURSIVE raw AS (
    SELECT coalesce(doc_id, {_LAST}) AS doc, text, unnest(string_split(text, chr(10))) AS line,
           generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos
    FROM (SELECT DISTINCT doc_id, text FROM documents)
), parsed AS (
    SELECT doc, text, pos, list_transform(regexp_extract_all(line, '{WORD}'),
           lambda w: CASE WHEN regexp_matches(w, '[0-9@]') THEN '<*>' ELSE w END) AS words FROM raw
), lines AS (
    SELECT *, len(words) AS n FROM parsed WHERE len(words) >= {LEAST}
), forms AS (
    SELECT n, list_slice(words, 1, {DEPTH}) AS leaf, words, count(DISTINCT doc) AS docs, min(doc) AS first, max(doc) AS last,
           min({{'doc': doc, 'pos': pos}}).pos AS pos
    FROM lines GROUP BY ALL
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY n, leaf ORDER BY docs DESC, first, pos) AS k FROM forms
), step AS (
    SELECT n, leaf, k, [words] AS leads, words, words AS template FROM ranked WHERE k = 1
    UNION ALL
    SELECT n, leaf, k, CASE WHEN len(met) = 0 THEN list_append(leads, words) ELSE leads END, words, CASE WHEN len(met) = 0 THEN words ELSE met[1] END
    FROM (SELECT r.n, r.leaf, r.k, r.words, s.leads, list_filter(s.leads, lambda lead: {SLACK} * len(list_filter(
              range(1, r.n + 1), lambda i: lead[i] <> r.words[i])) <= r.n) AS met
          FROM step s JOIN ranked r ON r.n = s.n AND r.leaf = s.leaf AND r.k = s.k + 1)
), templates AS (
    SELECT n, leaf, words, template, first, last FROM step JOIN forms USING (n, leaf, words)
), kept AS (
    SELECT words, min(first) OVER w AS keeper, max(last) OVER w AS other FROM templates WINDOW w AS (PARTITION BY n, leaf, template)
), gone AS (
    SELECT doc, text, pos FROM lines JOIN kept USING (words) WHERE keeper < other AND doc <> keeper
), dropped AS (
    SELECT doc, text, list(pos) AS gone FROM gone GROUP BY ALL
)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN 0 ELSE len(string_split(d.text, chr(10))) END AS n_lines,
       coalesce(len(gone), 0) AS n_dropped,
       CASE WHEN gone IS NULL THEN d.text ELSE coalesce(array_to_string(list_transform(
           list_filter(range(len(string_split(d.text, chr(10)))), lambda i: NOT list_contains(gone, i)),
           lambda i: string_split(d.text, chr(10))[i + 1]), chr(10)), '') END AS text
FROM documents d LEFT JOIN dropped g ON coalesce(d.doc_id, {_LAST}) = g.doc AND d.text = g.text
"""
