"""Trees from parent-child links by pointer doubling."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from conceptloom.functions.text import name_form, present
from conceptloom.runtime import Scratch

SEPARATOR = " > "


def prerequisite_links(relations: DataFrame) -> DataFrame:
    """(chapter_id, child, parent) of prerequisite relations, compared forms, each once; rows without both names give none."""
    is_link = F.coalesce(F.col("is_prereq"), F.lit(False)) | F.coalesce(name_form("relation") == "requires", F.lit(False))
    return (
        relations.filter(is_link)
        .select(F.coalesce("chapter_id", F.lit("")).alias("chapter_id"), name_form("source_name").alias("child"), name_form("target_name").alias("parent"))
        .filter(present(F.col("child")) & present(F.col("parent")))
        .distinct()
    )


def resolve_trees(links: DataFrame, scope: str = "chapter_id", with_path: bool = False) -> DataFrame:
    """Each name on a link with its root and depth: (scope, node, root, depth), and path if asked for.

    Every child points at its parent; in each round a pointer jumps to where its target points, so distances double and
    path segments are joined. A target that is no child is a root. A round that resolves nothing has shown that all
    nodes left are on or below a cycle (had any of them a finite depth, some of them would have ended in that round):
    they get root '' and depth -1, path null. A child with several parents counts under the smallest. An empty input
    gives an empty result; self links are cycles.
    """
    spark = links.sparkSession
    scratch = Scratch(spark, "trees")
    path = [F.array("child").alias("path")] if with_path else []
    start = links.groupBy(scope, "child").agg(F.min("parent").alias("parent")).select(scope, F.col("child").alias("node"), F.col("parent").alias("at"), F.lit(1).cast("long").alias("dist"), F.lit(False).alias("done"), *path)
    state, k, done = scratch.save(start, "state0"), 0, -1
    while True:
        resolved = state.filter("done").count() if k else 0
        if resolved == done:
            break
        done, k = resolved, k + 1
        target = state.select(F.col(scope).alias("__s"), F.col("node").alias("__n"), F.col("at").alias("__at"), F.col("dist").alias("__dist"), F.col("done").alias("__done"), *([F.col("path").alias("__path")] if with_path else []))
        open_ = state.filter(~F.col("done")).join(target, (F.col(scope) == F.col("__s")) & (F.col("at") == F.col("__n")), "left")
        ended = F.col("__n").isNull()  # the target has no parent
        step = open_.select(
            scope,
            "node",
            F.when(ended, F.col("at")).otherwise(F.col("__at")).alias("at"),
            F.when(ended, F.col("dist")).otherwise(F.col("dist") + F.col("__dist")).alias("dist"),
            (ended | F.coalesce("__done", F.lit(False))).alias("done"),
            *([F.when(ended, F.col("path")).otherwise(F.concat("path", "__path")).alias("path")] if with_path else []),
        )
        following = scratch.save(step.unionByName(state.filter("done")), f"state{k}")
        scratch.drop(f"state{k - 1}")
        state = following
        if not state.filter(~F.col("done")).head(1):
            break
    children = state.select(
        scope,
        "node",
        F.when(F.col("done"), F.col("at")).otherwise("").alias("root"),
        F.when(F.col("done"), F.col("dist")).otherwise(F.lit(-1)).cast("long").alias("depth"),
        *([F.when(F.col("done"), F.array_join(F.concat(F.array("at"), F.reverse("path")), SEPARATOR)).alias("path")] if with_path else []),
    )
    roots = state.filter("done").select(scope, F.col("at").alias("node"), F.col("at").alias("root"), F.lit(0).cast("long").alias("depth"), *([F.col("at").alias("path")] if with_path else [])).distinct()
    return children.unionByName(roots)


def descendants(links: DataFrame, scope: str = "chapter_id") -> DataFrame:
    """Every (scope, ancestor, descendant, distance) of the trees; nodes on or below a cycle have none.

    The tables of ancestors within 2^k steps are joined with themselves until no pair is new, so the rounds are
    logarithmic in the depth; the result itself has as many rows as the depths of all nodes together.
    """
    scratch = Scratch(links.sparkSession, "descendants")
    trees = resolve_trees(links, scope)
    tree_nodes = trees.filter("depth > 0").select(scope, F.col("node").alias("child"), "depth")
    one = links.groupBy(scope, "child").agg(F.min("parent").alias("parent")).join(tree_nodes, [scope, "child"])
    known = scratch.save(one.select(scope, F.col("parent").alias("ancestor"), F.col("child").alias("descendant"), F.lit(1).cast("long").alias("distance"), "depth"), "k0")
    k, reach = 0, 1
    while known.filter((F.col("distance") == reach) & (F.col("depth") > reach)).head(1):
        k += 1
        upper = known.select(F.col(scope).alias("__s"), F.col("ancestor").alias("__a"), F.col("descendant").alias("__d"), F.col("distance").alias("__dist"))
        at_reach = known.filter(F.col("distance") == reach)
        more = at_reach.join(upper, (F.col(scope) == F.col("__s")) & (F.col("ancestor") == F.col("__d"))).select(
            scope, F.col("__a").alias("ancestor"), "descendant", (F.col("distance") + F.col("__dist")).alias("distance"), "depth"
        )
        following = scratch.save(known.unionByName(more), f"k{k}")
        scratch.drop(f"k{k - 1}")
        known, reach = following, reach * 2
    return known.drop("depth")
