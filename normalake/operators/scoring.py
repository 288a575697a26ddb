"""Scoring of predicted spans against gold ones, and structural checks.

Spans are (doc, category, start, end), ends exclusive.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: No norm has so many articles; a larger number comes from a misread marker.
MOST_NUMBER = 100_000
SPAN = ["doc", "category", "start", "end"]
COUNTS = ["gold", "pred", "exact_tp", "overlap_tp_pred", "overlap_tp_gold"]


def _overlapping(a: DataFrame, b: DataFrame) -> DataFrame:
    o = b.select(F.col("doc").alias("_d"), F.col("category").alias("_c"), F.col("start").alias("_s"), F.col("end").alias("_e"))
    return a.join(o.hint("merge"), (F.col("doc") == F.col("_d")) & (F.col("category") == F.col("_c")) & (F.col("start") < F.col("_e")) & (F.col("_s") < F.col("end")), "left_semi")


def _sides(gold: DataFrame, pred: DataFrame) -> DataFrame:
    """Each span once, with how often it is gold and how often predicted, and
    whether it is both (a span with a null is like no other): one aggregation
    with map-side combination, instead of joins of both sides."""
    rows = gold.select(*SPAN, F.lit(1).alias("g")).union(pred.select(*SPAN, F.lit(0).alias("g")))
    met = rows.groupBy(*SPAN).agg(F.sum("g").alias("gold"), F.sum(1 - F.col("g")).alias("pred"))
    whole = ~(F.col("doc").isNull() | F.col("category").isNull() | F.col("start").isNull() | F.col("end").isNull())
    return met.withColumn("exact", whole & (F.col("gold") > 0) & (F.col("pred") > 0))


def counts(gold: DataFrame, pred: DataFrame) -> DataFrame:
    """By category: gold, pred, exact_tp, overlap_tp_pred, overlap_tp_gold."""
    def per(df: DataFrame, name: str, n: Column) -> DataFrame:
        return df.groupBy("category").agg(F.sum(n).alias("n")).select("category", F.lit(name).alias("what"), "n")

    both = _sides(gold, pred)
    golds, preds = both.where("gold > 0"), both.where("pred > 0")
    g, p = F.col("gold"), F.col("pred")
    parts = per(golds, "gold", g).union(per(preds, "pred", p)).union(per(preds.where("exact"), "exact_tp", p)).union(per(_overlapping(preds, golds), "overlap_tp_pred", p)).union(per(_overlapping(golds, preds), "overlap_tp_gold", g))
    names = ["gold", "pred", "exact_tp", "overlap_tp_pred", "overlap_tp_gold"]
    return parts.groupBy("category").agg(*[F.sum(F.when(F.col("what") == n, F.col("n")).otherwise(0)).alias(n) for n in names])


def _batch_counts(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The figures of counts() over a batch of whole documents."""
    sides, categories = [], []
    for name in ("label", "found"):
        lists = batch[name]
        doc = pc.list_parent_indices(lists).to_numpy()
        flat = lists.flatten()
        category, start, end = (flat.field(flat.type.get_field_index(n)) for n in ("category", "start", "end"))
        # a span with a null is like no other
        whole = np.logical_and.reduce([x.is_valid().to_numpy(zero_copy_only=False) for x in (category, start, end, batch["doc"].take(pa.array(doc)))])
        sides.append((doc, whole, *(pc.fill_null(x, 0).to_numpy(zero_copy_only=False) for x in (start, end))))
        categories.append(category.cast(pa.string()))
    both = pa.chunked_array(categories).combine_chunks().dictionary_encode(null_encoding="encode")
    codes, n = both.indices.to_numpy(), len(both.dictionary)
    cut = len(categories[0])
    # places as ranks, so that a document, a category and a place are one number
    values, ranks = np.unique(np.concatenate([x for s in sides for x in s[2:]]), return_inverse=True)
    most, at, marked = len(values) + 1, 0, []
    for (doc, whole, *_), kind in zip(sides, (codes[:cut], codes[cut:])):
        start, end = ranks[at : at + len(doc)], ranks[at + len(doc) : at + 2 * len(doc)]
        at += 2 * len(doc)
        marked.append((kind, whole, (doc.astype(np.int64) * n + kind) * most, start, end))

    def overlapping(a, b) -> np.ndarray:
        """Which of a begin before a span of b ends that begins before they end:
        the furthest end of those that do is enough."""
        (_, some, key, start, end), (_, other, of, begins, ends) = a, b
        order = np.argsort((of + begins)[other], kind="stable")
        begun, furthest = (of + begins)[other][order], np.maximum.accumulate((of + ends)[other][order])
        last = np.searchsorted(begun, key + end) - 1
        met = some & (last >= 0)
        met[met] = furthest[last[met]] > (key + start)[met]
        return met

    gold, pred = marked
    joint = np.unique(np.concatenate([gold[2] + gold[3], pred[2] + pred[3]]), return_inverse=True)[1] * most + np.concatenate([gold[4], pred[4]])
    exact = pred[1] & np.isin(joint[cut:], joint[:cut][gold[1]])
    sums = lambda kind, which: pa.array(np.bincount(kind[which], minlength=n).astype(np.int64))
    every = lambda side: np.ones(len(side[0]), bool)
    figures = [sums(gold[0], every(gold)), sums(pred[0], every(pred)), sums(pred[0], exact), sums(pred[0], overlapping(pred, gold)), sums(gold[0], overlapping(gold, pred))]
    return pa.RecordBatch.from_arrays([both.dictionary, *figures], names=["category", *COUNTS])


def counts_by_doc(rows: DataFrame) -> DataFrame:
    """counts() of stored rows (doc, label, found) that have a document's gold
    and predicted spans as lists: they meet within the row, so only figures are
    shuffled. Rows of one document become one first."""
    if not rows.groupBy("doc").count().where("count > 1").isEmpty():
        one = lambda n: F.flatten(F.collect_list(n)).alias(n)
        rows = rows.groupBy("doc").agg(one("label"), one("found"))
    lists = rows.select("doc", *[F.coalesce(n, F.array().cast(rows.schema[n].dataType)).alias(n) for n in ("label", "found")])
    parts = lists.mapInArrow(lambda batches: map(_batch_counts, batches), "category string, " + ", ".join(f"{n} long" for n in COUNTS))
    return parts.groupBy("category").agg(*[F.sum(n).alias(n) for n in COUNTS])


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b == 0, F.lit(0.0)).otherwise(a / b)


def metrics(counted: DataFrame) -> DataFrame:
    """Precision, recall and F1, exact and by overlap, for each category and
    for all (MICRO)."""
    names = ["gold", "pred", "exact_tp", "overlap_tp_pred", "overlap_tp_gold"]
    every = counted.unionByName(counted.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names]).withColumn("category", F.lit("MICRO")))
    every = every.withColumn("p", _ratio(F.col("exact_tp"), F.col("pred"))).withColumn("r", _ratio(F.col("exact_tp"), F.col("gold"))).withColumn("op", _ratio(F.col("overlap_tp_pred"), F.col("pred"))).withColumn("orc", _ratio(F.col("overlap_tp_gold"), F.col("gold")))
    f1 = lambda p, r: _ratio(2 * F.col(p) * F.col(r), F.col(p) + F.col(r))
    return every.select("category", *names, F.col("p").alias("exact_p"), F.col("r").alias("exact_r"), f1("p", "r").alias("exact_f1"), F.col("op").alias("overlap_p"), F.col("orc").alias("overlap_r"), f1("op", "orc").alias("overlap_f1"))


def errors(gold: DataFrame, pred: DataFrame) -> DataFrame:
    """boundary, missed (fn) and spurious (fp) spans: exact matches leave, the
    others of a document and category pair greedily in order."""
    times = F.concat(F.array_repeat(F.lit(0), F.col("gold").cast("int")), F.array_repeat(F.lit(1), F.col("pred").cast("int")))
    rest = _sides(gold, pred).where("NOT exact").select(*SPAN, F.explode(times).alias("side"))

    def close(key, golds, preds) -> list[tuple]:
        """Both sides in order of their starts. Predictions that end before a
        gold span ends are none of a later one's, so each enters a window once
        and leaves it once taken or passed."""
        out, window, taken, ahead = [], [], set(), 0
        for start, end in golds:
            while ahead < len(preds) and preds[ahead][0] < end:
                window.append(ahead)
                ahead += 1
            window = [i for i in window if preds[i][1] > start]
            fits = next((k for k, i in enumerate(window) if preds[i][0] < end), None)
            if fits is None:
                out.append((*key, "fn", start, end, None, None))
            else:
                i = window.pop(fits)
                taken.add(i)
                out.append((*key, "boundary", start, end, *preds[i]))
        return out + [(*key, "fp", None, None, *p) for i, p in enumerate(preds) if i not in taken]

    def pair(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["doc", "category", "kind", "start", "end", "pred_start", "pred_end"]
        table = lambda rows: pd.DataFrame(rows, columns=names, dtype=object)
        key, sides = None, ([], [])
        for frame in frames:
            out = []
            for doc, category, start, end, side in frame.itertuples(index=False, name=None):
                if (doc, category) != key:
                    out += close(key, *sides) if key else []
                    key, sides = (doc, category), ([], [])
                sides[side].append((start, end))
            yield table(out)
        yield table(close(key, *sides) if key else [])

    kind = gold.schema["doc"].dataType.simpleString()
    # a document's spans of a category come together and in order; a task streams through its groups
    ordered = rest.repartition("doc", "category").sortWithinPartitions(*SPAN)
    return ordered.mapInPandas(pair, f"doc {kind}, category string, kind string, start long, end long, pred_start long, pred_end long")


def category_gaps(spans: DataFrame, space: DataFrame) -> DataFrame:
    """Categories of spans that the label space lacks (unknown), and those of
    the space without a span (without examples)."""
    used = spans.select("category").distinct()
    unknown = used.join(space, "category", "left_anti").select("category", F.lit("unknown").alias("what"))
    return unknown.union(space.select("category").join(used, "category", "left_anti").select("category", F.lit("without examples").alias("what")))


def error_groups(found: DataFrame) -> DataFrame:
    rank = F.when(F.col("kind") == "boundary", 0).when(F.col("kind") == "fn", 1).otherwise(2)
    return found.groupBy("kind", "category").agg(F.count("*").alias("n")).orderBy(rank, "category")


def out_of_order(numbers: DataFrame) -> DataFrame:
    """numbers (doc, pos, n) lower than one before."""
    before = Window.partitionBy("doc").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    return numbers.withColumn("running", F.max("n").over(before)).where("n < running").drop("running")


def missing(numbers: DataFrame) -> DataFrame:
    """Which of 1 to the largest are not there, by doc. Numbers over
    MOST_NUMBER are misread ones and do not count."""
    seen = numbers.where(f"n > 0 AND n <= {MOST_NUMBER}").groupBy("doc").agg(F.max("n").alias("most"), F.collect_set("n").alias("have"))
    return seen.select("doc", F.explode(F.array_except(F.sequence(F.lit(1).cast("bigint"), F.col("most").cast("bigint")), F.transform("have", lambda x: x.cast("bigint")))).alias("n"))


def adjacent_overlaps(spans: DataFrame) -> DataFrame:
    """Spans that the next of their document begins within."""
    w = Window.partitionBy("doc").orderBy("start", "end", "category")
    return spans.withColumn("next_start", F.lead("start").over(w)).where("next_start < end")
