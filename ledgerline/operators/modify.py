"""Line modifications: labels (D21), ingredient lists with multipliers (D22), ingredient usage.

A line's final ingredient set is ``(recipe ∪ extras) − exclusions`` (a topping is dropped as soon
as it is excluded; an extra already in the recipe counts once). Two equivalent forms:

* **per distinct modification** (default): lists become arrays and the set algebra is row-wise; the
  work that depends on the lists (resolution, name join, ordering, rendering) runs once per
  distinct list or (item, exclusions, extras) combination and is joined back to the lines, so per
  line only a hash-join probe remains. How the per-list / per-combination tables are joined back is left to their
  size at run time, dimension joins are planned by size, and nothing is collected to the driver.
* **relational form**: the tagged UNION ALL of recipe/extra/exclusion rows (made in one pass), grouped per
  (line, topping) with a HAVING on exclusions, then joined and re-aggregated per line: the
  reference's own plan, kept as the cross-check of the default form.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.text import split_ids
from ledgerline.operators.delivery import delivered
from ledgerline.operators.rank import expand_ranges, line_number_ranges, number_lines

# A line's outputs depend only on its item and modification lists, so lines are numbered within their
# order by these columns; lines tied on them give identical output rows whatever number each gets.
LINE_CONTENT = ["pizza_id", "exclusions", "extras"]


def _empty() -> Column:
    return F.array().cast("array<int>")


def line_ids(lines: DataFrame) -> DataFrame:
    """Stable line identity (order_id, record_id): lines numbered within their order by content."""
    return number_lines(lines, "order_id", LINE_CONTENT, out="record_id")


def recipe_sets(bridge: DataFrame) -> DataFrame:
    """pizza_id -> distinct recipe topping ids (bounded by the size of one recipe)."""
    return bridge.groupBy("pizza_id").agg(F.array_sort(F.collect_set("topping_id")).alias("recipe_ids"))


def resolve_modifications(lines: DataFrame, bridge: DataFrame) -> DataFrame:
    """Adds ``recipe_ids``, ``extra_ids``, ``exclusion_ids`` and the final ``ingredient_ids`` to every line."""
    extras = F.coalesce(split_ids(F.col("extras")), _empty())
    excl = F.coalesce(split_ids(F.col("exclusions")), _empty())
    return (lines.join(recipe_sets(bridge), "pizza_id", "left")
            .withColumn("recipe_ids", F.coalesce(F.col("recipe_ids"), _empty()))
            .withColumn("extra_ids", extras)
            .withColumn("exclusion_ids", excl)
            .withColumn("ingredient_ids", F.array_except(F.array_union(F.col("recipe_ids"), F.col("extra_ids")),
                                                         F.col("exclusion_ids"))))


# ---------------------------------------------------------------- D21 labels

#: Slices of the orders for each task: a list text that most lines have, or none, is joined slice by slice.
SLICES_A_TASK = 4


def _list_labels(lines: DataFrame, toppings: DataFrame, col: str, prefix: str, out: str, tasks: int | None) -> DataFrame:
    """``prefix`` + topping names in list order, once per distinct list text and slice that has it (ids without a
    topping are skipped; a list with no known topping gets no label)."""
    lists = lines.where(F.col(col).isNotNull()).select(F.col(col).alias(f"{out}_list"), F.col("_slice").alias(f"{out}_slice")).distinct()
    key = [f"{out}_list", f"{out}_slice"]
    if tasks:  # as the lines are dealt in _labelled
        lists = lists.repartition(tasks, *key)
    exploded = lists.select(*key, F.posexplode(split_ids(F.col(f"{out}_list"))).alias("_pos", "topping_id"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("_pos", "topping_name"))), lambda s: s["topping_name"])
    return (exploded.join(toppings, "topping_id").groupBy(*key)
            .agg(F.concat(F.lit(prefix), F.array_join(ordered, ", ")).alias(out)))


def _labelled(lines: DataFrame, labels: DataFrame, col: str, out: str, tasks: int | None) -> DataFrame:
    """The lines with the label of their list; each (list, slice) meets in one of ``tasks``, lines without a list by slice."""
    if tasks:
        lines = lines.repartition(tasks, col, "_slice")
    same = (F.col(col) == F.col(f"{out}_list")) & (F.col("_slice") == F.col(f"{out}_slice"))
    return lines.join(labels, same, "left").drop(f"{out}_list", f"{out}_slice")


def order_item_label(lines: DataFrame, names: DataFrame, toppings: DataFrame, method: str = "lists",
                     record_id: bool = False, tasks: int | None = None) -> DataFrame:
    """``Name - Exclude a, b - Extra c, d`` per line; absent parts skipped; ids without a topping
    are ignored; names keep list order. Lines whose item has no name are dropped (inner join).

    Default: each distinct list text is labelled once a slice of the orders (explode, join, regroup; bounded by
    one list) and the labels are joined back to the lines by list text and slice, so that the lines of one frequent text, or without
    one, are dealt over ``tasks`` (default: the session's partitions). Nothing runs while the query is built:
    whether a label table is broadcast is left to its size in bytes at run time. ``record_id`` adds the line's number
    within its order, by which the reference sorts without listing it.
    """
    if method == "relational":
        return _order_item_label_relational(lines, names, toppings)
    if record_id:
        lines = line_ids(lines)
    key = ["order_id", "record_id"] if record_id else ["order_id"]
    slices = SLICES_A_TASK * (tasks or int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    lines = lines.select(*key, *LINE_CONTENT, F.pmod(F.xxhash64("order_id"), F.lit(slices)).alias("_slice"))
    excl = _list_labels(lines, toppings, "exclusions", "Exclude ", "_excl", tasks)
    extra = _list_labels(lines, toppings, "extras", "Extra ", "_extra", tasks)
    j = _labelled(lines.join(names, "pizza_id"), excl, "exclusions", "_excl", tasks)
    j = _labelled(j, extra, "extras", "_extra", tasks)
    return j.select(*key, "pizza_id", F.concat_ws(" - ", "pizza_name", "_excl", "_extra").alias("order_item"))


def _order_item_label_relational(lines: DataFrame, names: DataFrame, toppings: DataFrame) -> DataFrame:
    numbered = line_ids(lines)
    key = ["order_id", "record_id"]

    def part(col: str, prefix: str, out: str) -> DataFrame:
        e = (numbered.select(*key, F.posexplode(split_ids(F.col(col))).alias("pos", "topping_id"))
             .join(toppings, "topping_id"))
        ordered = F.transform(F.array_sort(F.collect_list(F.struct("pos", "topping_name"))), lambda s: s["topping_name"])
        return e.groupBy(*key).agg(F.concat(F.lit(prefix), F.array_join(ordered, ", ")).alias(out))

    j = (numbered.join(names, "pizza_id")
         .join(part("exclusions", "Exclude ", "_excl"), key, "left")
         .join(part("extras", "Extra ", "_extra"), key, "left"))
    return j.select("order_id", "pizza_id", F.concat_ws(" - ", "pizza_name", "_excl", "_extra").alias("order_item"))


# ---------------------------------------------------------------- D22 ingredient lists

def _render(items: Column) -> Column:
    """Sorted (name, is_extra) structs -> ``'2x A, B, …'``; every extra gets the prefix (reference quirk)."""
    return F.array_join(
        F.transform(F.array_sort(items),
                    lambda s: F.when(s["is_extra"], F.concat(F.lit("2x "), s["name"])).otherwise(s["name"])),
        ", ")


def rendered_combinations(lines: DataFrame, bridge: DataFrame, names: DataFrame, toppings: DataFrame) -> DataFrame:
    """``Name: 2x Extra, Other, …`` once per distinct (pizza_id, exclusions, extras) of ``lines``.

    Combinations that keep no named ingredient, or whose item has no name, give no row.
    """
    combos = resolve_modifications(lines.select(*LINE_CONTENT).distinct(), bridge)
    exploded = combos.select(*LINE_CONTENT, "extra_ids", F.explode("ingredient_ids").alias("topping_id"))
    named = exploded.join(toppings, "topping_id").select(
        *LINE_CONTENT, F.struct(F.col("topping_name").alias("name"),
                                F.array_contains(F.col("extra_ids"), F.col("topping_id")).alias("is_extra")).alias("_item"))
    per_combo = named.groupBy(*LINE_CONTENT).agg(F.collect_list("_item").alias("_items"))
    return per_combo.join(names, "pizza_id").select(
        *LINE_CONTENT, F.concat(F.col("pizza_name"), F.lit(": "), _render(F.col("_items"))).alias("ingredient_list"))


def ingredient_list_with_multiplier(lines: DataFrame, bridge: DataFrame, names: DataFrame, toppings: DataFrame,
                                    method: str = "combinations") -> DataFrame:
    """Per line ``Name: 2x Extra, Other, …`` ordered by topping name (bytewise).

    Output (order_id, record_id, ingredient_list). Lines with no remaining ingredient, or whose
    item has no name, give no row (inner joins in the reference). Default: every distinct
    (item, exclusions, extras) is resolved and rendered once, then joined (NULL-safe) to the
    numbered line ranges of each order and expanded to one row per line. Whether the rendered
    combinations are broadcast is left to their size in bytes at run time.
    """
    if method == "relational":
        return _ingredient_list_relational(lines, bridge, names, toppings)
    ranges = line_number_ranges(lines, "order_id", LINE_CONTENT)
    rendered = rendered_combinations(lines, bridge, names, toppings).select(
        *[F.col(c).alias(f"_r_{c}") for c in LINE_CONTENT], "ingredient_list")
    same = [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in LINE_CONTENT]
    cond = same[0]
    for c in same[1:]:
        cond = cond & c
    joined = ranges.join(rendered, cond).select("order_id", "_n", "_first", "ingredient_list")
    return expand_ranges(joined, "record_id").select("order_id", "record_id", "ingredient_list")


def tagged_toppings(numbered: DataFrame, bridge: DataFrame) -> DataFrame:
    """Relational form of the resolution: one row per (line, topping) left after exclusions, with
    ``is_extra``. ``numbered`` carries the line identity (order_id, record_id).

    The rows of the UNION ALL of recipe, extras and exclusions come from one pass over the lines: three branches would number
    the lines three times within each task."""
    key = ["order_id", "record_id", "pizza_id"]

    def tagged(ids: Column, kind: str) -> Column:
        rows = F.transform(ids, lambda i: F.struct(i.alias("topping_id"), F.lit(kind).alias("topping_type")))
        return F.coalesce(rows, F.array().cast("array<struct<topping_id:int,topping_type:string>>"))

    union = F.concat(tagged(F.col("recipe_ids"), "standard"), tagged(split_ids(F.col("extras")), "extra"),
                     tagged(split_ids(F.col("exclusions")), "exclusion"))
    kind = F.col("topping_type")
    return (numbered.join(recipe_sets(bridge), "pizza_id", "left").select(*key, F.inline(union))
            .groupBy(*key, "topping_id")
            .agg(F.max(F.when(kind == "extra", 1).otherwise(0)).alias("is_extra"),
                 F.count_if(kind == "exclusion").alias("_excluded"))
            .where(F.col("_excluded") == 0).drop("_excluded"))


def _ingredient_list_relational(lines: DataFrame, bridge: DataFrame, names: DataFrame, toppings: DataFrame) -> DataFrame:
    final = tagged_toppings(line_ids(lines), bridge).join(toppings, "topping_id")
    items = F.collect_list(F.struct(F.col("topping_name").alias("name"), (F.col("is_extra") == 1).alias("is_extra")))
    per_line = final.join(names, "pizza_id").groupBy("order_id", "record_id", "pizza_name").agg(items.alias("_items"))
    return per_line.select(
        "order_id", "record_id", F.concat(F.col("pizza_name"), F.lit(": "), _render(F.col("_items"))).alias("ingredient_list"))


# ---------------------------------------------------------------- D23 usage

def ingredient_usage_delivered(lines: DataFrame, orders: DataFrame, bridge: DataFrame, toppings: DataFrame,
                               method: str = "array", count_extras_twice: bool = False) -> DataFrame:
    """How often each topping is used over delivered lines' final ingredient sets.

    The default counts a topping once per line (an extra already in the recipe counts once, as the
    reference groups by (line, topping)); ``count_extras_twice`` counts recipe and extra separately.
    Counting happens per topping id with map-side partial aggregation, before any name join.
    """
    shipped = delivered(lines, orders)
    if method == "relational" and count_extras_twice:
        raise ValueError("count_extras_twice needs method='array': the relational form keeps one row per line and topping")
    if method == "relational":
        ids = tagged_toppings(line_ids(shipped), bridge).select("topping_id", F.lit(1).alias("_w"))
    else:
        # resolve each distinct (item, exclusions, extras) once, weighted by its number of lines:
        # the grouping combines map-side, so the array work no longer grows with the line count
        combos = shipped.groupBy("pizza_id", "exclusions", "extras").agg(F.count(F.lit(1)).alias("_w"))
        res = resolve_modifications(combos, bridge)
        used = F.col("ingredient_ids")
        if count_extras_twice:
            doubled = F.array_except(F.array_intersect(F.col("extra_ids"), F.col("recipe_ids")), F.col("exclusion_ids"))
            used = F.concat(used, doubled)
        ids = res.select(F.explode(used).alias("topping_id"), "_w")
    per_id = ids.groupBy("topping_id").agg(F.sum("_w").alias("_n"))
    return (per_id.join(toppings, "topping_id").groupBy("topping_name")
            .agg(F.sum("_n").cast("long").alias("total_quantity")))
