"""Frequency of every distinct term and n-gram of terms: suffix-sorted counting."""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _count_sorted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Aggregate all prefix counts of reverse-lexicographically sorted suffixes with a stack.

    A suffix row is (field, suffix, seen, n): n occurrences of the truncated suffix, of which the prefixes of up to
    ``seen`` terms count at another suffix of the same record, so that only longer ones count for a new record.
    In reverse order a prefix follows all suffixes that extend it; what the stack holds at depth l is the
    prefix of l terms with all its counts so far. ``seen`` takes the place of a set of record ids: it makes the
    number of records additive.
    """
    field, path, cf, rf = None, [], [], []
    out: list[tuple] = []

    def pop(to: int) -> None:
        while len(path) > to:
            out.append((field, list(path), cf[-1], rf[-1]))
            path.pop()
            c = cf.pop()
            rf.pop()
            if cf:
                cf[-1] += c

    for pdf in batches:
        for f, suffix, seen, n in zip(pdf["field"], pdf["suffix"], pdf["seen"], pdf["n"]):
            suffix = list(suffix)
            same = 0
            if f == field:
                for x, y in zip(path, suffix):
                    if x != y:
                        break
                    same += 1
            pop(same)
            field = f
            for x in suffix[same:]:
                path.append(x)
                cf.append(0)
                rf.append(0)
            cf[-1] += n
            for depth in range(seen, len(suffix)):
                rf[depth] += n
        if len(out) > 20_000:
            yield pd.DataFrame(out, columns=["field", "ngram", "occurrences", "records"])
            out = []
    pop(0)
    yield pd.DataFrame(out, columns=["field", "ngram", "occurrences", "records"])


def _suffixes(terms, max_len: int):  # noqa: ANN001, ANN202
    """Truncated suffixes of a record, sorted, each with the length of the prefix that it shares with the one before it.

    Suffixes that share a prefix follow each other, so that every distinct prefix is longer than what is shared at one of them only: there it
    counts for the record. Sorting takes n log n comparisons of at most ``max_len`` terms, however long the record.
    """
    sorted_ = F.array_sort(F.transform(F.sequence(F.lit(1), F.size(terms)), lambda i: F.slice(terms, i, max_len)))

    def shared(s, p):  # noqa: ANN001, ANN202
        return F.size(F.filter(F.sequence(F.lit(1), F.size(s)), lambda k: F.slice(s, 1, k) == F.slice(p, 1, k)))

    def pairs(xs):  # noqa: ANN001, ANN202
        return F.transform(xs, lambda s, i: F.struct(s.alias("suffix"), F.when(i > 0, shared(s, F.get(xs, i - 1))).otherwise(0).alias("seen")))

    # The sorted array is bound once, as the only element of an array, instead of being sorted anew for each suffix.
    return F.when(F.size(terms) > 0, F.transform(F.array(sorted_), pairs)[0])


def ngram_counts(df: DataFrame, fields: dict[str, str], max_len: int = 1, partitions: int | None = None, salts: int = 1) -> DataFrame:
    """Count every n-gram of up to ``max_len`` terms: field, ngram (array), occurrences, records.

    ``fields`` maps a field's name to its array<string> column; a row is a record. Suffixes truncated to
    ``max_len`` terms are routed by field and first term, sorted in reverse lexicographic order within each
    partition, and one pass with a stack counts all their prefixes. Equal suffixes are added up before they
    are routed, so that a term in a third of all records is a few rows by then; ``salts`` > 1 also spreads the
    suffixes of one first term, and the counts of the parts are added at the end (they are additive).

    Defined results: a null or empty array counts for nothing, a null term is dropped, a term repeated in a record counts
    each time in occurrences and once in records, an empty table gives no rows. Other columns are ignored.
    """
    arrays = [F.struct(F.lit(f).alias("field"), F.array_compact(F.col(f"`{c}`")).alias("terms")) for f, c in fields.items()]
    rows = df.select(F.explode(F.array(*arrays)).alias("x")).where(F.size("x.terms") > 0)
    suffixes = rows.select("x.field", F.explode(_suffixes(F.col("x.terms"), max_len)).alias("s")).select("field", "s.suffix", "s.seen")
    counted = suffixes.groupBy("field", "suffix", "seen").agg(F.count(F.lit(1)).alias("n"))
    route = [F.col("field"), F.col("suffix")[0]] + ([F.pmod(F.xxhash64("suffix"), F.lit(salts))] if salts > 1 else [])
    routed = counted.repartition(*([partitions] if partitions else []), *route).sortWithinPartitions(F.desc("field"), F.desc("suffix"))
    out = routed.mapInPandas(_count_sorted, "field string, ngram array<string>, occurrences long, records long")
    if salts > 1:
        out = out.groupBy("field", "ngram").agg(F.sum("occurrences").alias("occurrences"), F.sum("records").alias("records"))
    return out


def marked(counts: DataFrame, records: int, rare: int, common: float) -> DataFrame:
    """Add mark: 'rare' for at most ``rare`` records, 'common' for more than the share ``common`` of all records, else null.

    What is both (a tiny table) is rare.
    """
    mark = F.when(F.col("records") <= rare, "rare").when(F.col("records") > F.lit(Decimal(str(common)) * records), "common")
    return counts.withColumn("mark", mark)
