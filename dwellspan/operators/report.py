"""Reports of partners and advertisers."""

from __future__ import annotations

import html
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def partner_rows(entitled: DataFrame, measured: DataFrame, tally: DataFrame) -> DataFrame:
    """partner, surface, source, seconds, method, counts: what each partner got on each surface that it is entitled to.

    entitled: partner, surface, surface_pos, source; measured: partner, source, seconds; tally (by hand):
    partner, surface, seconds. A hand count goes before a measurement. One source that feeds two
    surfaces counts in the total once, on the first.
    """
    t = tally.select("partner", "surface", F.col("seconds").alias("hand"))
    m = measured.select("partner", "source", F.col("seconds").alias("auto"))
    rows = entitled.join(m, ["partner", "source"], "left").join(t, ["partner", "surface"], "left")
    rows = rows.withColumn("method", F.when(F.col("hand").isNotNull(), "hand").when(F.col("auto").isNotNull(), "measured").otherwise("not measured"))
    rows = rows.withColumn("seconds", F.coalesce("hand", "auto"))
    first = F.row_number().over(Window.partitionBy("partner", "source", F.col("method") == "measured").orderBy("surface_pos")) == 1
    return rows.withColumn("counts", (F.col("method") == "hand") | ((F.col("method") == "measured") & first)).drop("hand", "auto")


def partner_totals(rows: DataFrame) -> DataFrame:
    """partner, total_s, n_surfaces, n_measured."""
    return rows.groupBy("partner").agg(F.sum(F.when(F.col("counts"), F.col("seconds")).otherwise(0.0)).alias("total_s"), F.count("*").alias("n_surfaces"), F.count("seconds").alias("n_measured"))


def not_entitled(entitled: DataFrame, measured: DataFrame) -> DataFrame:
    """Measured sources of partners that no entitlement names."""
    return measured.join(entitled, ["partner", "source"], "left_anti")


def census(exposure: DataFrame, brand: str, line: str, seconds: str) -> DataFrame:
    """brand, by_line (map of seconds), total_s."""
    lines = exposure.groupBy(brand, line).agg(F.sum(seconds).alias("s"))
    return lines.groupBy(brand).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(line, "s")))).alias("by_line"), F.sum("s").alias("total_s"))


def rolled_up(exposure: DataFrame, keys: Sequence[str], seconds: str) -> DataFrame:
    """Totals of all levels of keys; level counts the keys that are summed over."""
    return exposure.rollup(*keys).agg(F.sum(seconds).alias("total"), F.grouping_id().alias("level"))


def shot_summary(shots: DataFrame, kind: str, length: str, route: str) -> DataFrame:
    """kind, n_shots, total_s, auto_s, review_s."""
    return shots.groupBy(kind).agg(F.count("*").alias("n_shots"), F.sum(length).alias("total_s"), F.sum(F.when(F.col(route) == "auto", F.col(length)).otherwise(0)).alias("auto_s"), F.sum(F.when(F.col(route) != "auto", F.col(length)).otherwise(0)).alias("review_s"))


def shot_text(title: str, shots: DataFrame, clusters: DataFrame | None = None, limit: int = 10_000) -> str:
    """A text report of shots (shot, t_start, t_end, dur_s, kind, route, note, doubts) by time, then the doubtful ones, then runs of fast cuts (first, last, n).

    It shows at most limit shots and says how many there are; counts and sums come from all of them.
    """
    said = shots.agg(F.count("*").alias("n"), F.coalesce(F.max("t_end"), F.lit(0.0)).alias("end"), F.count_if(F.size("doubts") > 0).alias("doubtful")).first()
    at = lambda s: f"{int(s) // 60:02d}:{int(s) % 60:02d}"
    out = [f"{title}: {said.n} shots, {at(said.end)}", ""]
    rows = shots.orderBy("t_start", "shot").limit(limit).collect()
    out += [f"{r.shot:>5}  {at(r.t_start)} - {at(r.t_end)}  {r.dur_s:7.1f} s  {r.kind or '-':<10} {r.route or '-':<8} {r.note or ''}".rstrip() for r in rows]
    out += ["", f"doubtful: {said.doubtful} of {said.n}"]
    out += [f"{r.shot:>5}  {at(r.t_start)}  {', '.join(r.doubts)}" for r in rows if r.doubts]
    if clusters is not None:
        runs = clusters.orderBy("first").limit(limit).collect()
        out += ["", f"fast cuts: {len(runs)} runs", *(f"       {at(r.first)} - {at(r.last)}  {r.n} shots" for r in runs)]
    return "\n".join(out) + "\n"


def nested(tables: dict[str, DataFrame], key: str) -> DataFrame:
    """key and report: one JSON document a key that holds the rows of each table under its name; missing parts are empty lists."""
    out = None
    for name, rows in tables.items():
        rest = [c for c in rows.columns if c != key]
        own = rows.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(*rest))).alias(name))
        out = own if out is None else out.join(own, key, "full")
    return out.select(key, F.to_json(F.struct(*(F.coalesce(F.col(n), F.array()).alias(n) for n in tables))).alias("report"))


def as_json(rows: DataFrame, key: str, name: str) -> DataFrame:
    """One row for each key with its rows as a JSON array."""
    rest = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(F.to_json(F.array_sort(F.collect_list(F.struct(*rest)))).alias(name))


def as_html(title: str, tables: dict[str, DataFrame], limit: int = 1000) -> str:
    """A page of report tables; each shows at most limit rows and says how many there are."""
    out = [f"<!doctype html><meta charset='utf-8'><title>{html.escape(title)}</title><h1>{html.escape(title)}</h1>"]
    for name, df in tables.items():
        total, rows = df.count(), df.limit(limit).collect()
        head = "".join(f"<th>{html.escape(c)}</th>" for c in df.columns)
        body = "".join("<tr>" + "".join(f"<td>{html.escape('-' if v is None else str(v))}</td>" for v in r) + "</tr>" for r in rows)
        out.append(f"<h2>{html.escape(name)} ({total})</h2><table><tr>{head}</tr>{body}</table>")
    return "\n".join(out)
