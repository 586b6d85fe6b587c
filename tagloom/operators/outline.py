"""The elements around the rows of a document, checked over all its splits.

What stands outside rows is a sequence of tags. A stretch of it reduces to a short value: the
end tags whose start is before the stretch, then the start tags whose end is behind it, with a
mark wherever an element was complete, or opened, at the level the stretch had reached. Two neighbouring values merge by the same
rule, so a document is reduced in three steps: stretches of some thousand records, splits,
the whole. It has one root and nothing beside it if one mark remains.

Namespace prefixes that rows or loose tags use without declaring them have to be declared by the
root. Where an element between root and rows declares one, its scope is a matter of places, and the document is
read again as a whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: One element, complete at the level of the stretch; tags that do not match.
DONE, BROKEN = "*", "!"
#: Records of a stretch, which one array of tags holds.
STRETCH = 4096
_NO_NAMES = "array<string>"


def reduced(tokens: Column) -> Column:
    """A sequence of `name`, `/name` and DONE as the shortest sequence that merges alike; [BROKEN] if tags cross."""
    none = F.array().cast(_NO_NAMES)
    start = F.struct(none.alias("before"), none.alias("open"), F.lit(False).alias("broken"))

    def state(before: Column, open_: Column, broken: Column) -> Column:
        return F.struct(before.alias("before"), open_.alias("open"), broken.alias("broken"))

    def marked(before: Column) -> Column:
        """One more mark; more than two in a row say no more than two."""
        n = F.size(before)
        two = (n > 1) & (F.get(before, n - 1) == DONE) & (F.get(before, n - 2) == DONE)
        return F.when(two, before).otherwise(F.concat(before, F.array(F.lit(DONE))))

    def step(s: Column, token: Column) -> Column:
        before, open_, n = s["before"], s["open"], F.size(s["open"])
        ends = token.startswith("/")
        closes = F.get(open_, n - 1) == F.substring(token, 2, 1 << 30)
        return (
            F.when(s["broken"] | (token == BROKEN), state(before, open_, F.lit(True)))
            .when(token == DONE, state(F.when(n == 0, marked(before)).otherwise(before), open_, F.lit(False)))
            .when(~ends, state(before, F.concat(open_, F.array(token)), F.lit(False)))
            .when(n == 0, state(F.concat(before, F.array(token)), open_, F.lit(False)))
            .when(
                closes,
                state(F.when(n == 1, marked(before)).otherwise(before), F.slice(open_, F.lit(1), n - 1), F.lit(False)),
            )
            .otherwise(state(before, open_, F.lit(True)))
        )

    finish = lambda s: F.when(s["broken"], F.array(F.lit(BROKEN))).otherwise(F.concat(s["before"], s["open"]))
    return F.aggregate(F.coalesce(tokens, none), start, step, finish)


def _merged(parts: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Neighbouring values merged: (keys, tags)."""
    in_order = F.sort_array(F.collect_list(F.struct(order, "tags")))
    return parts.groupBy(*keys).agg(reduced(F.flatten(F.transform(in_order, lambda p: p["tags"]))).alias("tags"))


def _row_places(cut: DataFrame) -> DataFrame:
    """(source, first_row, last_row) of all sources; by split first, as numbers, which is the only grouping of all records here."""
    at = F.when(F.col("tag").isNotNull(), F.col("at"))
    ends = cut.groupBy("source", "split").agg(F.min(at).alias("first"), F.max(at).alias("last"))
    place = lambda c: F.when(F.col(c).isNotNull(), F.struct("split", F.col(c).alias("at")))
    return ends.groupBy("source").agg(F.min(place("first")).alias("first_row"), F.max(place("last")).alias("last_row"))


def _names_beside(cut: DataFrame) -> DataFrame:
    """Places of the first and last loose tag of a source, and the prefixes it declares and uses; of the few records that tell."""
    place, tagged = F.struct("split", "at"), F.size("loose.tags") > 0
    used = F.concat(F.coalesce("loose.uses", F.array()), F.coalesce("foreign", F.array()))
    return cut.filter("loose IS NOT NULL OR foreign IS NOT NULL").groupBy("source").agg(
        F.min(F.when(tagged, place)).alias("first_tag"),
        F.max(F.when(tagged, place)).alias("last_tag"),
        F.min_by("loose.first_declares", F.when(tagged, place)).alias("scope"),
        F.array_distinct(F.flatten(F.collect_set(F.when(F.size("loose.declares") > 0, F.col("loose.declares"))))).alias("declares"),
        F.array_distinct(F.flatten(F.collect_set(F.when(F.size(used) > 0, used)))).alias("uses"),
    )


def outlines(typed: DataFrame) -> DataFrame:
    """(source, tags, enclosed, unbound, scoped) of each source that was cut.

    `tags`: all its loose tags, reduced. `enclosed`: no row stands before the first or behind the last of
    them. `unbound`: prefixes that are used but not declared by the root; `scoped`: whether another loose tag declares one of those.
    """
    cut = typed.filter("split IS NOT NULL")
    loose = cut.filter(F.size("loose.tags") > 0)
    stretch = F.expr(f"at div {STRETCH}").alias("stretch")
    stretches = _merged(loose.select("source", "split", "at", "loose.tags", stretch), ["source", "split", "stretch"], "at")
    splits = _merged(stretches, ["source", "split"], "stretch")
    documents = _merged(splits, ["source"], "split")
    rows, names = _row_places(cut), _names_beside(cut).join(documents, "source", "full")
    names = rows.join(names, "source", "left").withColumns({c: F.coalesce(c, F.array().cast(_NO_NAMES)) for c in ("uses", "declares")})
    unbound = F.array_except("uses", F.coalesce("scope", F.array()))
    return (
        names.withColumn("unbound", unbound)
        .select(
            "source",
            F.coalesce("tags", F.array()).alias("tags"),
            (
                F.col("first_row").isNull()
                | (F.col("first_tag") < F.col("first_row")) & (F.col("last_row") <= F.col("last_tag"))
            ).alias("enclosed"),
            "unbound",
            F.arrays_overlap("unbound", "declares").alias("scoped"),
        )
    )
