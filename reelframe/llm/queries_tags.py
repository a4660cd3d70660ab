"""Queries over music_tag: p4 to p6."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelframe.llm.ngram_counts import marked, ngram_counts
from reelframe.llm.pair_table import PairTable
from reelframe.llm.set_join import similar_pairs
from reelframe.llm.tags import compared_tags, current_rows
from reelframe.session import cut, read, spread

MIN_TOGETHER, MIN_LIFT = 5, 3
#: Hash buckets of the pair table: tags make tens of thousands of pairs, some thousands a bucket.
TAG_BUCKETS = 8
RARE_TRACKS, COMMON_SHARE = 2, 0.18
MIN_SIMILARITY = 0.6


def _tracks(spark: SparkSession, d: str, fields: list[str]) -> DataFrame:
    """The current rows of the tracks with the tags of each field in their compared form."""
    rows = current_rows(read(spark, d, "music_tag"), "track_id", "loaded_at", fields)
    arrays = [F.array(F.col(f)) if f == "energy" else F.col(f) for f in fields]
    return rows.select("track_id", *[compared_tags(a).alias(f) for f, a in zip(fields, arrays)])


def _pair_table(spark: SparkSession, d: str) -> PairTable:
    """The pair table after two batches: the baskets as first loaded, and then those that a later row changed."""
    rows = read(spark, d, "music_tag").where("track_id IS NOT NULL").select("track_id", "emotion", "style", "loaded_at")
    tags, at = F.struct("emotion", "style"), F.struct("loaded_at", F.xxhash64("emotion", "style"))
    versions = rows.groupBy("track_id").agg(F.min_by(tags, at).alias("f"), F.max_by(tags, at).alias("l"))
    versions = spread(versions, ["track_id"])
    baskets = cut(versions.select("track_id", *[F.concat(compared_tags(f"{v}.emotion"), compared_tags(f"{v}.style")).alias(v) for v in "fl"]))
    table = PairTable(spark, buckets=TAG_BUCKETS)
    table.apply(baskets.withColumn("none", F.array().cast("array<string>")), "none", "f")
    table.apply(baskets, "f", "l")
    return table


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    s = _pair_table(spark, d).scores()
    big = lambda c: F.col(c).cast("decimal(19,0)")  # noqa: E731  (products of counts outgrow 64 bits)
    enough = (F.col("n_ab") >= MIN_TOGETHER) & (big("n_ab") * big("n") >= MIN_LIFT * big("n_a") * big("n_b"))
    return s.where(enough).select(F.col("a").alias("tag_a"), F.col("b").alias("tag_b"))


def p4_scores(spark: SparkSession, d: str) -> DataFrame:
    """The recomputed scores of the pairs that the last batch of changes affected."""
    t = _pair_table(spark, d)
    return t.scores(t.changed_items()).select("a", "b", "n", "n_a", "n_b", "n_ab", F.round("lift", 6).alias("lift"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    tracks = cut(_tracks(spark, d, ["emotion", "style", "energy"]))
    counts = ngram_counts(tracks, {"emotion": "emotion", "style": "style", "energy": "energy"}, max_len=2, salts=4)
    terms = marked(counts.where(F.size("ngram") == 1), tracks.count(), RARE_TRACKS, COMMON_SHARE)
    return terms.where("mark IS NOT NULL").select("field", F.col("ngram")[0].alias("term"), "mark")


def p5_ngrams(spark: SparkSession, d: str) -> DataFrame:
    """All terms and runs of up to three terms with their counts and marks."""
    tracks = cut(_tracks(spark, d, ["emotion", "style", "energy"]))
    counts = ngram_counts(tracks, {"emotion": "emotion", "style": "style", "energy": "energy"}, max_len=3, salts=4)
    return marked(counts, tracks.count(), RARE_TRACKS, COMMON_SHARE).select("field", F.array_join("ngram", " ").alias("ngram"), F.size("ngram").alias("terms"), "occurrences", "records", "mark")


def _similar_tracks(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    tracks = _tracks(spark, d, ["emotion", "style", "placement"]).where("size(emotion) > 0 AND size(style) > 0 AND size(placement) > 0")
    pairs, members = similar_pairs(tracks.select("track_id", F.concat("emotion", "style", "placement").alias("tags")), MIN_SIMILARITY, "track_id", "tags")
    return pairs, cut(members)


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """The cases are pairs of tracks, so that the classes of equal sets are expanded here, last of all."""
    pairs, members = _similar_tracks(spark, d)
    a, b = (members.select(F.col("class").alias(f"class_{x}"), F.col("id").alias(f"id_{x}")).hint("merge") for x in "ab")
    ids = pairs.select("class_a", "class_b").join(a, "class_a").join(b, "class_b").where("class_a <> class_b OR id_a < id_b")
    return ids.select(F.least("id_a", "id_b").alias("track_a"), F.greatest("id_a", "id_b").alias("track_b"))


def p6_links(spark: SparkSession, d: str) -> DataFrame:
    """One row a track: its class of equal sets, the tracks in it, and its links to other tracks; classes are joined, never expanded to pairs of tracks."""
    pairs, members = _similar_tracks(spark, d)
    sizes = members.groupBy("class").agg(F.count(F.lit(1)).alias("tracks"))
    other = pairs.where("class_a <> class_b")
    ends = other.select("class_a", "class_b").unionByName(other.select(F.col("class_b").alias("class_a"), F.col("class_a").alias("class_b")))
    links = ends.join(sizes.withColumnRenamed("class", "class_b").hint("merge"), "class_b").groupBy(F.col("class_a").alias("class")).agg(F.sum("tracks").alias("others"))
    rows = sizes.join(links.hint("merge"), "class", "left").withColumn("links", F.col("tracks") - 1 + F.coalesce("others", F.lit(0)))
    return members.join(rows.hint("merge"), "class").select(F.col("id").alias("track_id"), "class", "tracks", "links")


QUERIES = {"p4_found": p4_found, "p4_scores": p4_scores, "p5_found": p5_found, "p5_ngrams": p5_ngrams, "p6_found": p6_found, "p6_links": p6_links}

# DuckDB has no NFKC; of the spelling variants in these tables it changes full-width letters and white space.
_WIDE = "".join(chr(c) for c in range(0xFF01, 0xFF5F))
_NARROW = "".join(chr(c) for c in range(0x21, 0x7F)).replace("'", "''")
_TAG = rf"regexp_replace(lower(translate(x, '{_WIDE}', '{_NARROW}')), '[\s\x{{3000}}\x{{a0}}]+', '', 'g')"
_CURRENT = "cur AS (SELECT * FROM music_tag WHERE track_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY track_id ORDER BY loaded_at DESC NULLS LAST) = 1)"


def _list(field: str) -> str:
    return f"list_filter(list_transform(list_filter(coalesce({field}, []), lambda x: x IS NOT NULL), lambda x: {_TAG}), lambda y: y <> '')"


_BASKETS = f"""
{_CURRENT}, bag AS (SELECT track_id, list_distinct(list_concat({_list("emotion")}, {_list("style")})) AS tags FROM cur),
one AS (SELECT track_id, unnest(tags) AS tag FROM bag), n AS (SELECT count(*) AS n FROM bag WHERE len(tags) > 0),
na AS (SELECT tag, count(*) AS n_a FROM one GROUP BY tag),
nab AS (SELECT x.tag AS a, y.tag AS b, count(*) AS n_ab FROM one x JOIN one y ON x.track_id = y.track_id AND x.tag < y.tag GROUP BY ALL),
sc AS (SELECT a, b, n, p.n_a, q.n_a AS n_b, n_ab, n_ab * n / (p.n_a * q.n_a) AS lift FROM nab, n, na p, na q WHERE p.tag = a AND q.tag = b)
"""
_FIRST = "fst AS (SELECT * FROM music_tag WHERE track_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY track_id ORDER BY loaded_at NULLS FIRST) = 1)"
_SEQ = " UNION ALL ".join(
    f"SELECT track_id, '{f}' AS field, {_list(f if f != 'energy' else '[energy]')} AS t FROM cur" for f in ("emotion", "style", "energy")
)
_SIMILAR = f"""{_CURRENT}, s AS (SELECT track_id, {_list("emotion")} AS e, {_list("style")} AS s, {_list("placement")} AS p FROM cur),
        k AS (SELECT track_id, list_distinct(list_concat(e, s, p)) AS t FROM s WHERE len(e) > 0 AND len(s) > 0 AND len(p) > 0),
        o AS (SELECT track_id, len(t) AS z, unnest(t) AS tag FROM k),
        c AS (SELECT x.track_id AS track_a, y.track_id AS track_b, any_value(x.z) AS za, any_value(y.z) AS zb, count(*) AS n
              FROM o x JOIN o y ON x.tag = y.tag AND x.track_id < y.track_id GROUP BY 1, 2)"""
SQL = {
    "p4_found": f"WITH {_BASKETS} SELECT a AS tag_a, b AS tag_b FROM sc WHERE n_ab >= 5 AND n_ab * n >= 3 * n_a * n_b",
    "p4_scores": f"""WITH {_BASKETS}, {_FIRST}, old AS (SELECT track_id, list_distinct(list_concat({_list("emotion")}, {_list("style")})) AS tags FROM fst),
        moved AS (SELECT list_sort(o.tags) AS o, list_sort(b.tags) AS b FROM old o JOIN bag b USING (track_id) WHERE list_sort(o.tags) <> list_sort(b.tags)),
        dt AS (SELECT tag, sum(d) AS d FROM (SELECT unnest(b) AS tag, 1 AS d FROM moved UNION ALL SELECT unnest(o), -1 FROM moved) GROUP BY tag),
        mo AS (SELECT row_number() OVER () AS i, * FROM moved), ex AS (SELECT i, unnest(b) AS tag, 1 AS d FROM mo UNION ALL SELECT i, unnest(o), -1 FROM mo),
        dp AS (SELECT x.tag AS a, y.tag AS b, sum(x.d) AS d FROM ex x JOIN ex y ON x.i = y.i AND x.d = y.d AND x.tag < y.tag GROUP BY ALL),
        hit AS (SELECT tag FROM dt WHERE d <> 0 UNION SELECT a FROM dp WHERE d <> 0 UNION SELECT b FROM dp WHERE d <> 0)
        SELECT a, b, n, n_a, n_b, n_ab, round(lift, 6) AS lift FROM sc WHERE a IN (SELECT tag FROM hit) OR b IN (SELECT tag FROM hit)""",
    "p5_found": f"""WITH {_CURRENT}, seq AS ({_SEQ}), n AS (SELECT count(*) AS n FROM cur),
        c AS (SELECT field, term, count(DISTINCT track_id) AS k FROM (SELECT track_id, field, unnest(t) AS term FROM seq) GROUP BY ALL)
        SELECT field, term, CASE WHEN k <= 2 THEN 'rare' ELSE 'common' END AS mark FROM c, n WHERE k <= 2 OR k > 0.18 * n""",
    "p5_ngrams": f"""WITH {_CURRENT}, seq AS ({_SEQ}), n AS (SELECT count(*) AS n FROM cur),
        g AS (SELECT track_id, field, k AS terms, array_to_string(t[i : i + k - 1], ' ') AS ngram
              FROM (SELECT *, unnest(range(1, len(t) + 1)) AS i FROM seq), range(1, 4) r(k) WHERE i + k - 1 <= len(t)),
        c AS (SELECT field, ngram, CAST(terms AS INTEGER) AS terms, count(*) AS occurrences, count(DISTINCT track_id) AS records FROM g GROUP BY ALL)
        SELECT c.*, CASE WHEN records <= 2 THEN 'rare' WHEN records > 0.18 * n THEN 'common' END AS mark FROM c, n""",
    "p6_found": f"""WITH {_SIMILAR} SELECT track_a, track_b FROM c WHERE n * 10 >= 6 * (za + zb - n)""",
    "p6_links": f"""WITH {_SIMILAR}, e AS (SELECT track_a AS i FROM c WHERE n * 10 >= 6 * (za + zb - n) UNION ALL SELECT track_b FROM c WHERE n * 10 >= 6 * (za + zb - n)),
        l AS (SELECT i, count(*) AS links FROM e GROUP BY 1)
        SELECT track_id, min(track_id) OVER (PARTITION BY list_sort(t)) AS class, count(*) OVER (PARTITION BY list_sort(t)) AS tracks, coalesce(links, 0) AS links FROM k LEFT JOIN l ON track_id = i""",
}
