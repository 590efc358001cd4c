"""Graph operators on edge tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finloom.storage import discard, hand_over, materialise, spread, temporary

#: Pairs of members of groups that a task makes (some 250 MB where they are summed up).
TASK_PAIRS = 2_000_000


def endpoints(edges: DataFrame) -> DataFrame:
    """id once for each end of each edge (src, dst)."""
    return edges.select(F.col("src").alias("id")).unionAll(edges.select(F.col("dst").alias("id")))


def degrees(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """id and degree of every node, 0 included."""
    n = endpoints(edges).groupBy("id").agg(F.count("*").alias("degree"))
    return nodes.select("id").join(n, "id", "left").select("id", F.coalesce("degree", F.lit(0)).cast("long").alias("degree"))


def structural_metrics(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """One row: node_count, relationship_count, density (directed), avg_degree, orphan_node_ratio."""
    of_nodes = degrees(nodes, edges).agg(
        F.count("*").alias("node_count"), F.avg("degree").alias("d"), F.avg((F.col("degree") == 0).cast("double")).alias("o")
    )
    n = F.col("node_count")
    return of_nodes.crossJoin(edges.agg(F.count("*").alias("relationship_count"))).select(  # one row each
        "node_count",
        "relationship_count",
        F.when(n > 1, F.round(F.col("relationship_count") / (n * (n - 1)), 8)).otherwise(0.0).alias("density"),
        F.round("d", 4).alias("avg_degree"),
        F.round("o", 4).alias("orphan_node_ratio"),
    )


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a vertex is tied to the smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy(F.col("a").alias("v")).agg(F.min("b").alias("low"))
    return (
        both.join(spread(low), F.col("a") == F.col("v"))
        .where(F.col("b") > F.col("a"))
        .select(F.col("b").alias("a"), F.least("a", "low").alias("b"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """A vertex and its smaller neighbours are tied to the smallest of them."""
    low = edges.groupBy(F.col("a").alias("v")).agg(F.min("b").alias("low"))
    tied = edges.join(spread(low), F.col("a") == F.col("v"))
    return (
        tied.where(F.col("b") != F.col("low"))
        .select(F.col("b").alias("a"), F.col("low").alias("b"))
        .unionByName(low.select(F.col("v").alias("a"), F.col("low").alias("b")))
        .distinct()
    )


def components(links: DataFrame) -> DataFrame:
    """vertex and root, its component's smallest vertex, for all vertices with a
    link but the roots.

    links: columns a and b of one orderable type, no nulls; loops, repeats and
    either direction are allowed.  Large and small stars alternate until
    nothing changes: each round keeps as many edges at most and shrinks
    distances; every table is written, so a lost executor costs one round.
    """
    edges = materialise(
        links.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "components-0",
    )
    sign = (F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0)))
    before, n = None, 0
    while before != (now := tuple(edges.agg(*sign).first())):
        before, n, old = now, n + 1, edges
        edges = materialise(_small_star(_large_star(old)), f"components-{n}")
        discard(old)
    return hand_over(edges, edges.select(F.col("a").alias("vertex"), F.col("b").alias("root")))


def component_sizes(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """root and size of every component; a node without edges is one of its own."""
    found = components(edges.select(F.col("src").alias("a"), F.col("dst").alias("b")))
    labelled = nodes.join(found, F.col("id") == F.col("vertex"), "left").select(F.coalesce("root", "id").alias("root"))
    return labelled.groupBy("root").agg(F.count("*").alias("size"))


def _sides(edges: DataFrame, label: str) -> tuple[DataFrame, DataFrame]:
    """Written: every edge once, whatever its direction, without loops; and a view
    of it as edges in both directions."""
    once = edges.where(F.col("src") != F.col("dst")).select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")).distinct()
    once = materialise(once, label)
    return once, once.unionAll(once.select(F.col("dst").alias("src"), F.col("src").alias("dst")))


def hop_distances(edges: DataFrame, start: DataFrame, hops: int) -> DataFrame:
    """Written: id and distance of what ``start`` (id) reaches over undirected edges in at
    most ``hops`` steps.  Each step joins the frontier, not all nodes found.  Edges are
    written once, not made again for each step; those with a null end don't count."""
    with temporary(edges.sparkSession) as kept:
        _, both = _sides(edges, "hops-edges")
        found = frontier = materialise(start.select("id", F.lit(0).alias("distance")).distinct(), "hops-0")
        for step in range(1, hops + 1):
            if frontier.isEmpty():
                break
            reached = frontier.join(both, F.col("id") == F.col("src")).select(F.col("dst").alias("id")).distinct()
            frontier = materialise(reached.join(found.select("id"), "id", "left_anti").withColumn("distance", F.lit(step)), f"hops-{step}")
            found = found.unionByName(frontier)
        kept.append(materialise(found, "hops"))
    return kept[0]


def pair_distances(edges: DataFrame, pairs: DataFrame, hops: int) -> DataFrame:
    """Written: a, b and distance (null beyond ``hops`` undirected steps) of every pair.

    Searches run 64 at a time: a node has one row for 64 sources, whose bits say
    which of them have reached it.  A step ORs the new bits along edges and keeps
    those that the node has not seen, so what it costs depends on nodes, edges
    and groups of 64 sources, not on pairs.  The pairs themselves are bits too:
    what a node is asked for travels in its row, and only the bits that arrive
    are returned.  Of both ends the one with fewer different values is searched
    from.  Ends that no edge touches reach themselves alone; a null end nothing.
    """
    with temporary(edges.sparkSession) as kept:
        pairs = materialise(pairs.select("a", "b").distinct(), "distances-pairs")
        sizes = pairs.agg(F.countDistinct("a").alias("a"), F.countDistinct("b").alias("b")).first()
        start, end = ("a", "b") if sizes["a"] <= sizes["b"] else ("b", "a")
        known = pairs.where(F.col("a").isNotNull() & F.col("b").isNotNull())
        number = F.monotonically_increasing_id()
        sources = materialise(known.select(start).distinct().select(start, number.alias("n")), "distances-sources")
        placed = sources.select(F.col(start), F.shiftright("n", 6).alias("word"), F.expr("shiftleft(1L, CAST(n & 63 AS INT))").alias("bit"))
        once, both = _sides(edges, "distances-edges")
        none = F.lit(0).cast("long")
        asked = known.join(spread(placed), start).select(F.col(end).alias("id"), "word", none.alias("seen"), none.alias("reached"), F.col("bit").alias("asked"))
        rows = asked.unionByName(placed.select(F.col(start).alias("id"), "word", none.alias("seen"), F.col("bit").alias("reached"), none.alias("asked")))
        arrived, old = None, None
        for step in range(hops + 1):
            state = rows.groupBy("id", "word").agg(*(F.bit_or(c).alias(c) for c in ("seen", "reached", "asked")))
            new = F.expr("reached & ~seen")
            state = materialise(state.select("id", "word", F.expr("seen | reached").alias("seen"), new.alias("new"), "asked"), f"distances-{step}")
            found = materialise(state.where("new & asked <> 0").select("id", "word", F.expr("new & asked").alias("bits"), F.lit(step).alias("distance")), f"distances-met{step}")
            arrived = found if arrived is None else arrived.unionByName(found)
            discard(*([old] if old is not None else []))
            old = state
            # Words that have all answers need no further steps.
            open_ = state.where("asked & ~seen <> 0").select("word").distinct()
            state = state.join(spread(open_), "word", "left_semi")
            frontier = state.where("new <> 0").select("id", "word", "new")
            if step == hops or frontier.isEmpty():
                break
            reached = both.join(spread(frontier), F.col("src") == F.col("id")).select(F.col("dst").alias("id"), "word", none.alias("seen"), F.col("new").alias("reached"), none.alias("asked"))
            rows = state.select("id", "word", "seen", none.alias("reached"), "asked").unionByName(reached)
        discard(old, once)
        each = arrived.select("id", "word", "distance", F.explode(F.expr("filter(sequence(0, 63), i -> shiftright(bits, i) & 1 = 1)")).alias("i"))
        met = each.join(sources.select(start, F.shiftright("n", 6).alias("word"), F.expr("CAST(n & 63 AS INT)").alias("i")), ["word", "i"])
        kept.append(materialise(pairs.join(met.select(start, F.col("id").alias(end), "distance"), ["a", "b"], "left").select("a", "b", "distance"), "distances"))
    return kept[0]


def cyclic_components(edges: DataFrame) -> DataFrame:
    """Written: vertex and component of every vertex on a directed cycle of any length,
    loops included; component is the smallest vertex of its strongly connected part.

    Vertices without an edge in or out are peeled off.  Then every vertex takes the
    smallest vertex that reaches it as its colour: a strongly connected part has
    one colour.  What reaches the vertex that a colour is named after, inside the
    colour, is that vertex's part; it is taken out, edges between colours go, and
    the rest starts again.  A round is a join and an aggregation; their number
    grows with the longest shortest path, not with the number of cycles.
    """
    loops = edges.where(F.col("src") == F.col("dst")).select(F.col("src").alias("vertex")).distinct()
    left = materialise(edges.where(F.col("src") != F.col("dst")).select("src", "dst").distinct(), "parts-edges")
    parts = []
    while not left.isEmpty():
        left = _peeled(left)
        colours = _colours(left)
        of = lambda end: spread(colours).select(F.col("vertex").alias(end), F.col("colour").alias(f"{end}_colour"))
        inside = left.join(of("src"), "src").join(of("dst"), "dst").where(F.col("src_colour") == F.col("dst_colour"))
        inside = materialise(inside.select("src", "dst", F.col("src_colour").alias("colour")), "parts-inside")
        discard(left, colours)
        part = _reaching_their_colour(inside)
        parts.append(part)
        gone = spread(part.select("vertex"))
        kept = inside.join(gone.withColumnRenamed("vertex", "src"), "src", "left_anti").join(gone.withColumnRenamed("vertex", "dst"), "dst", "left_anti")
        left = materialise(kept.select("src", "dst"), "parts-edges")
        discard(inside)
    discard(left)
    found = None
    for part in parts:
        found = part if found is None else found.unionByName(part)
    if found is None:
        return materialise(loops.select("vertex", F.col("vertex").alias("component")), "parts")
    alone = loops.join(found, "vertex", "left_anti").select("vertex", F.col("vertex").alias("component"))
    whole = materialise(found.unionByName(alone), "parts")
    discard(*parts)
    return whole


def _peeled(edges: DataFrame) -> DataFrame:
    """Written: edges between vertices that have edges in and out."""
    n = -1
    while (now := edges.count()) != n:
        n, old = now, edges
        kept = old.join(spread(old.select(F.col("dst").alias("src")).distinct()), "src", "left_semi")
        edges = materialise(kept.join(spread(old.select(F.col("src").alias("dst")).distinct()), "dst", "left_semi").select("src", "dst"), "parts-edges")
        discard(old)
    return edges


def _colours(edges: DataFrame) -> DataFrame:
    """Written: vertex and the smallest vertex that reaches it (or itself)."""
    vertices = edges.select(F.col("src").alias("vertex")).unionByName(edges.select(F.col("dst").alias("vertex"))).distinct()
    colours = materialise(vertices.select("vertex", F.col("vertex").alias("colour"), F.lit(True).alias("new")), "parts-colours")
    while not (news := colours.where("new")).isEmpty():
        sent = edges.join(spread(news.select(F.col("vertex").alias("src"), "colour")), "src").select(F.col("dst").alias("vertex"), F.lit(None).cast(colours.schema["colour"].dataType).alias("own"), F.col("colour").alias("got"))
        both = colours.select("vertex", F.col("colour").alias("own"), F.lit(None).cast(colours.schema["colour"].dataType).alias("got")).unionByName(sent)
        least = both.groupBy("vertex").agg(F.max("own").alias("own"), F.min("got").alias("got"))
        better = F.coalesce(F.col("got") < F.col("own"), F.lit(False))
        old, colours = colours, materialise(least.select("vertex", F.when(better, F.col("got")).otherwise(F.col("own")).alias("colour"), better.alias("new")), "parts-colours")
        discard(old)
    return colours


def _reaching_their_colour(inside: DataFrame) -> DataFrame:
    """Written: vertex and component of what reaches the vertex that its colour is
    named after, over edges inside colours, if that lies on a cycle."""
    named = inside.where(F.col("dst") == F.col("colour")).select(F.col("dst").alias("vertex"), F.col("colour").alias("component")).distinct()
    found = materialise(named.withColumn("new", F.lit(True)), "parts-found")
    while not (news := found.where("new")).isEmpty():
        back = inside.join(spread(news.select(F.col("vertex").alias("dst"))), "dst").select(F.col("src").alias("vertex"), F.col("colour").alias("component"), F.lit(True).alias("new"))
        both = found.select("vertex", "component", F.lit(False).alias("new")).unionByName(back)
        old, found = found, materialise(both.groupBy("vertex", "component").agg(F.min("new").alias("new")), "parts-found")
        discard(old)
    return hand_over(found, found.select("vertex", "component"))


def witness_cycles(edges: DataFrame, parts: DataFrame) -> DataFrame:
    """Written: component, position (from 0) and vertex: for every component of ``cyclic_components``
    one cycle, a shortest of those through its smallest vertex, which it begins with.

    All components search at once, a step a level; of equally short ways the one by
    smaller vertices before.  A row a vertex, so a cycle may be of any length.
    """
    with temporary(edges.sparkSession) as kept:
        of = lambda end: spread(parts).select(F.col("vertex").alias(end), F.col("component").alias(f"{end}_part"))
        inside = edges.select("src", "dst").distinct().join(of("src"), "src").join(of("dst"), "dst").where(F.col("src_part") == F.col("dst_part"))
        inside = materialise(inside.select("src", "dst", F.col("src_part").alias("component")), "witness-edges")
        none = F.lit(None).cast(inside.schema["src"].dataType)
        levels = [materialise(parts.select("component", F.col("component").alias("vertex"), none.alias("before")).distinct(), "witness-0")]
        seen, open_, closed = levels[0].where(F.lit(False)).select("component", "vertex"), levels[0].select("component"), []
        while not open_.isEmpty():
            last = levels[-1].join(spread(open_), "component", "left_semi")
            step = inside.join(last.select("component", F.col("vertex").alias("src")), ["component", "src"])
            fresh = step.join(seen.withColumnRenamed("vertex", "dst"), ["component", "dst"], "left_anti").groupBy("component", F.col("dst").alias("vertex")).agg(F.min("src").alias("before"))
            levels.append(materialise(fresh, f"witness-{len(levels)}"))
            # The root is not among what was seen, so a way back to it shows.
            seen = seen.unionByName(levels[-1].select("component", "vertex"))
            closed.append(levels[-1].where(F.col("vertex") == F.col("component")).select("component", "before"))
            open_ = materialise(open_.join(spread(closed[-1].select("component")), "component", "left_anti"), "witness-open")
        out = levels[0].select("component", F.lit(0).alias("position"), "vertex")
        back: DataFrame | None = None
        for depth in range(len(levels) - 1, 0, -1):
            here = closed[depth - 1].select("component", F.col("before").alias("vertex"))
            back = here if back is None else back.unionByName(here)
            if depth == 1:
                break
            back = materialise(back, f"witness-back{depth}")
            out = out.unionByName(back.select("component", F.lit(depth - 1).alias("position"), "vertex"))
            back = back.join(levels[depth - 1], ["component", "vertex"]).select("component", F.col("before").alias("vertex"))
        kept.append(materialise(out, "witnesses"))
    return kept[0]


def short_cycles(edges: DataFrame) -> DataFrame:
    """Directed cycles of two or three different vertices, once each: a < b, a < c
    (c null for two).

    Triangles are found at the vertex with the fewest neighbours, so a hub with
    very many edges in and out doesn't pair them all.
    """
    e = materialise(edges.where(F.col("src") != F.col("dst")).select("src", "dst").distinct(), "short-cycles")
    back = e.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    pairs = e.where("src < dst").join(back, ["src", "dst"], "left_semi").select(F.col("src").alias("a"), F.col("dst").alias("b"), F.lit(None).cast(e.schema["src"].dataType).alias("c"))
    sides = e.select(F.least("src", "dst").alias("x"), F.greatest("src", "dst").alias("y")).distinct()
    degree = sides.select(F.col("x").alias("v")).unionAll(sides.select(F.col("y").alias("v"))).groupBy("v").agg(F.count("*").alias("d"))
    of = lambda end: spread(degree).select(F.col("v").alias(end), F.struct("d", "v").alias(f"{end}_rank"))
    ranked = sides.join(of("x"), "x").join(of("y"), "y")
    low, high = F.least("x_rank", "y_rank"), F.greatest("x_rank", "y_rank")
    oriented = materialise(ranked.select(low["v"].alias("low"), high["v"].alias("high"), high.alias("rank")), "short-cycles-oriented")
    one, two = (oriented.select("low", F.col("high").alias(x), F.col("rank").alias(f"{x}_rank")) for x in ("v", "w"))
    closing = oriented.select(F.col("low").alias("v"), F.col("high").alias("w"))
    triangles = one.join(two, "low").where(F.col("v_rank") < F.col("w_rank")).select("low", "v", "w").join(closing, ["v", "w"], "left_semi")
    ways = triangles.select(F.inline(F.array(F.struct(F.col("low").alias("p"), F.col("v").alias("q"), F.col("w").alias("r")), F.struct(F.col("low").alias("p"), F.col("w").alias("q"), F.col("v").alias("r")))))
    for src, dst in (("p", "q"), ("q", "r"), ("r", "p")):
        ways = ways.join(e.select(F.col("src").alias(src), F.col("dst").alias(dst)), [src, dst], "left_semi")
    first = F.least("p", "q", "r")
    turned = F.when(F.col("p") == first, F.struct(F.col("p").alias("a"), F.col("q").alias("b"), F.col("r").alias("c")))
    turned = turned.when(F.col("q") == first, F.struct(F.col("q").alias("a"), F.col("r").alias("b"), F.col("p").alias("c"))).otherwise(F.struct(F.col("r").alias("a"), F.col("p").alias("b"), F.col("q").alias("c")))
    return pairs.unionByName(ways.select(turned.alias("t")).select("t.*"))


def layer_violations(edges: DataFrame, layers: DataFrame) -> DataFrame:
    """Edges from a lower to a higher layer, or inside one layer but the lowest;
    layers: id, layer."""
    of = lambda end: layers.select(F.col("id").alias(end), F.col("layer").alias(f"{end}_layer"))
    a, b = F.col("src_layer"), F.col("dst_layer")
    return edges.join(of("src"), "src").join(of("dst"), "dst").where((a < b) | ((a == b) & (a != 0)))


def shared_members(memberships: DataFrame, least: int, most_members: int | None = None) -> DataFrame:
    """Pairs a < b of items that share at least ``least`` groups, with n_shared
    and first_group; memberships: item, group.

    A group over ``most_members`` items makes no pairs.  That limit is part of
    the result: it is how the operator treats groups that say nothing about
    their members.

    Without it, the ``least`` - 1 largest groups of all make no pairs if theirs are
    most of all pairs: two items with enough groups in common share one of the
    others, where they meet, and what they share of the largest is added for
    pairs that it could help.  So a group that holds a third of all items makes no
    pairs of its own, unless one group in common is enough, when the pairs of a
    group are the result.  Where no group is that large all make pairs at once,
    with the same result and less written.  Beyond the ``least`` - 1 largest,
    groups make all their pairs in either case.
    """
    unique = materialise(memberships.distinct(), "memberships")
    sizes = unique.groupBy("group").agg(F.count("*").alias("n"))
    if most_members is not None:
        sizes = sizes.where(F.col("n") <= most_members)
        unique = unique.join(sizes.select("group"), "group", "left_semi")
    pairs = F.coalesce(F.sum(_pairs_of("n")), F.lit(0))
    total, most = sizes.agg(pairs, F.max("n")).first()
    if most_members is None and least > 1:
        largest = materialise(sizes.orderBy(F.desc("n"), "group").limit(least - 1), "largest-groups")
        theirs, most_left = largest.agg(pairs, F.min("n")).first()
        if 2 * theirs > total:
            return _sharing(unique, sizes, largest.select("group"), least, total - theirs, most_left)
    return (
        _meeting(unique, sizes, total, most)
        .groupBy("a", "b")
        .agg(F.count("*").alias("n_shared"), F.min("group").alias("first_group"))
        .where(F.col("n_shared") >= least)
    )


def _pairs_of(n: str) -> Column:
    return F.expr(f"{n} * ({n} - 1) div 2")


def _meeting(unique: DataFrame, sizes: DataFrame, total: int, most: int | None) -> DataFrame:
    """group, a and b of the ``total`` pairs a < b of groups of ``most`` members at most.
    A task makes some ``TASK_PAIRS`` of them, however many there are: what sums them up
    there holds no more.  Groups with more pairs are cut by one of the ends."""
    a, b = (unique.select("group", F.col("item").alias(x)) for x in "ab")
    on = ["group"]
    if total > TASK_PAIRS:
        if most * (most - 1) // 2 > TASK_PAIRS:
            cut = sizes.select("group", F.ceil(_pairs_of("n") / F.lit(TASK_PAIRS)).cast("int").alias("slices")).where("slices > 1")
            sliced = unique.join(spread(cut), "group", "left").withColumn("slices", F.coalesce("slices", F.lit(1)))
            a = sliced.select("group", F.col("item").alias("a"), F.pmod(F.xxhash64("item"), F.col("slices")).cast("int").alias("slice"))
            b = sliced.select("group", F.col("item").alias("b"), F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"))
            on = ["group", "slice"]
        # With fewer than the session's the join would deal them once more.
        parts = max(-(-total // TASK_PAIRS), int(unique.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        a, b = a.repartition(parts, *on), b.repartition(parts, *on)
    return a.join(b, on).where(F.col("a") < F.col("b")).select("group", "a", "b")


def _sharing(unique: DataFrame, sizes: DataFrame, largest: DataFrame, least: int, total: int, most: int) -> DataFrame:
    in_largest = unique.join(largest, "group", "left_semi")
    rest, rest_sizes = (x.join(largest, "group", "left_anti") for x in (unique, sizes))
    met = _meeting(rest, rest_sizes, total, most).groupBy("a", "b").agg(F.count("*").alias("n_rest"), F.min("group").alias("first_rest"))
    more_a, more_b = (in_largest.groupBy(F.col("item").alias(x)).agg(F.count("*").alias(f"more_{x}")) for x in "ab")
    could = met.join(more_a, "a", "left").join(more_b, "b", "left")
    could = could.where(F.col("n_rest") + F.least(F.coalesce("more_a", F.lit(0)), F.coalesce("more_b", F.lit(0))) >= least)
    could = materialise(could.select("a", "b", "n_rest", "first_rest"), "membership-pairs")
    of = lambda end: in_largest.select(F.col("item").alias(end), "group")
    more = could.select("a", "b").join(of("a"), "a").join(of("b"), ["b", "group"]).groupBy("a", "b").agg(F.count("*").alias("n_more"), F.min("group").alias("first_more"))
    both = could.join(more, ["a", "b"], "left").withColumn("n_shared", F.col("n_rest") + F.coalesce("n_more", F.lit(0)))
    return both.where(F.col("n_shared") >= least).select("a", "b", "n_shared", F.least("first_rest", "first_more").alias("first_group"))


def without_edges(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Nodes that no edge touches."""
    return nodes.join(endpoints(edges).distinct(), "id", "left_anti")


def valid_edges(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Distinct edges (src, dst, type) without loops, and whether the target is missing."""
    known = nodes.select(F.col("id").alias("dst"), F.lit(True).alias("known")).distinct()
    return (
        edges.where(F.col("src") != F.col("dst"))
        .select("src", "dst", "type")
        .distinct()
        .join(known, "dst", "left")
        .select("src", "dst", "type", F.col("known").isNull().alias("broken"))
    )
