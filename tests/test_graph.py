import itertools
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from corvane.operators import communities, cooccurrence as co, graph_stats as g, influence as inf, ranking, shells


def edges_of(spark, pairs):
    return spark.createDataFrame([tuple(sorted(p)) for p in pairs], "src string, dst string")


def nodes_of(spark, names):
    return spark.createDataFrame([(n,) for n in names], "id string")


TRIANGLE = ["ab", "bc", "ac", "cd"]


def test_paragraph_pairs(spark):
    rows = [(1, "anna"), (1, "boris"), (2, "boris"), (2, "anna"), (2, "clara"), (3, "dora")]
    mentions = spark.createDataFrame(rows, "para int, entity string")
    got = {(r.src, r.dst): r.weight for r in co.mention_edges(mentions, ["para"]).collect()}
    assert got == {("anna", "boris"): 2, ("anna", "clara"): 1, ("boris", "clara"): 1}
    assert {r.id for r in co.mention_nodes(mentions).collect()} == {"anna", "boris", "clara", "dora"}


@pytest.mark.parametrize("min_weight", [1, 2, 3])
def test_shared_groups_with_huge_groups(spark, min_weight):
    draw = random.Random(min_weight)
    rows = {(0, i) for i in range(60)} | {(1, i) for i in range(20, 70)} | {(2, i) for i in range(0, 70, 3)}
    rows |= {(draw.randrange(3, 60), draw.randrange(80)) for _ in range(300)}
    groups = {}
    for group, item in rows:
        groups.setdefault(group, set()).add(item)
    want = Counter(p for m in groups.values() for p in itertools.combinations(sorted(m), 2))
    want = {p: n for p, n in want.items() if n >= min_weight}
    df = spark.createDataFrame(sorted(rows) + [(0, 0)], "g int, i int")
    for light in (8, 1000):
        got = co.cooccurrence_edges(df, "g", "i", min_weight, light).collect()
        assert len(got) == len(want)
        assert {(r.src, r.dst): r.weight for r in got} == want


def test_the_largest_group_of_an_item_yields_no_candidates(spark):
    rows = [(0, i) for i in range(500)] + [(1, 3), (1, 4)]
    dense = spark.createDataFrame([(g_, i, 500) for g_, i in rows if g_ == 0], "g int, i int, n long")
    assert co._without_largest(dense, 1).count() == 0
    df = spark.createDataFrame(rows, "g int, i int")
    got = [(r.src, r.dst, r.weight) for r in co.cooccurrence_edges(df, "g", "i", 2, light=10).collect()]
    assert got == [(3, 4, 2)]


def test_degrees(spark):
    nodes, edges = nodes_of(spark, "abcde"), edges_of(spark, TRIANGLE)
    assert {r.id: r.degree for r in g.degrees(nodes, edges).collect()} == {"a": 2, "b": 2, "c": 3, "d": 1, "e": 0}
    stats = g.degree_stats(nodes, edges).first()
    assert (stats.n_nodes, stats.mean_degree) == (5, 1.6)
    assert [r.id for r in g.by_degree(nodes, edges).collect()] == ["c", "a", "b", "d", "e"]
    assert g.degree_assortativity(edges).first()[0] < 0


def test_shells_of_triangle_with_tail(spark):
    got = shells.k_shells(nodes_of(spark, "abcde"), edges_of(spark, TRIANGLE))
    assert {r.id: r.shell for r in got.collect()} == {"a": 2, "b": 2, "c": 2, "d": 1, "e": 0}


def peel(pairs):
    near = {}
    for a, b in pairs:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    shell, k = {}, 0
    while near:
        low = [n for n in near if len(near[n]) <= k]
        if not low:
            k += 1
        for n in low:
            shell[n] = k
            for m in near.pop(n):
                if m in near:
                    near[m].discard(n)
    return shell


def test_shells_equal_peeling(spark):
    draw = random.Random(3)
    pairs = {tuple(sorted(draw.sample(range(60), 2))) for _ in range(240)} | {(0, i) for i in range(1, 60)}
    edges = spark.createDataFrame(sorted(pairs), "src int, dst int")
    got = {r.id: r.shell for r in shells.k_shells(g.nodes_of(edges), edges).collect()}
    assert got == peel(pairs)
    table = {r.shell: r.n for r in shells.shell_table(shells.k_shells(g.nodes_of(edges), edges)).collect()}
    assert table[0] == 0 and sum(table.values()) == len(got)


def test_no_edges(spark):
    nodes, edges = nodes_of(spark, "ab"), edges_of(spark, [])
    assert [r.shell for r in shells.k_shells(nodes, edges).collect()] == [0, 0]
    assert communities.final_partition(communities.louvain(nodes, edges)).count() == 2


def cliques():
    left = list(itertools.combinations("abcde", 2))
    right = list(itertools.combinations("vwxyz", 2))
    return [*left, *right, ("e", "v")]


def test_communities_are_the_cliques(spark):
    edges = edges_of(spark, cliques())
    levels = communities.louvain(nodes_of(spark, "abcdevwxyz"), edges)
    got = {r.id: r.community for r in communities.final_partition(levels).collect()}
    assert got == {**dict.fromkeys("abcde", 0), **dict.fromkeys("vwxyz", 1)}


def test_modularity_never_falls_by_level(spark):
    draw = random.Random(5)
    pairs = {tuple(sorted(draw.sample(range(40), 2))) for _ in range(90)}
    edges = spark.createDataFrame(sorted(pairs), "src int, dst int")
    levels = communities.louvain(g.nodes_of(edges), edges)
    depth = levels.agg(F.max("level")).first()[0]
    values = [g.modularity(edges, levels.filter(F.col("level") == i)).first()[0] for i in range(depth + 1)]
    assert values == sorted(values) and values[-1] > values[0]


def test_modularity_by_hand(spark):
    parts = spark.createDataFrame([(n, 0 if n in "abcde" else 1) for n in "abcdevwxyz"], "id string, community int")
    edges = edges_of(spark, cliques())
    m = 21
    assert g.modularity(edges, parts).first()[0] == pytest.approx(20 / m - 2 * (21 / (2 * m)) ** 2)
    quotient = g.quotient_graph(edges, parts).collect()
    assert [(r.src, r.dst, r.weight) for r in quotient] == [(0, 1, 1)]
    assert g.community_count(parts).first()[0] == 2
    assert {r.size for r in g.community_members(parts).collect()} == {5}


def seeds(spark, rows):
    return spark.createDataFrame(rows, "strategy string, id string")


def test_certain_cascade_walks_the_path(spark):
    edges = edges_of(spark, ["ab", "bc"])
    reached = inf.cascades(edges, seeds(spark, [("s", "a")]), p=1.0, runs=2, seed=1)
    series = inf.cascade_series(reached).orderBy("run", "step").collect()
    assert [r.infected for r in series] == [1, 2, 3, 1, 2, 3]
    stats = inf.strategy_stats(reached).first()
    assert (stats.mean_size, stats.var_size, stats.longest) == (3.0, 0.0, 2)


def test_impossible_cascade_stays(spark):
    reached = inf.cascades(edges_of(spark, TRIANGLE), seeds(spark, [("s", "a"), ("s", "b")]), 0.0, 3, 1)
    assert reached.count() == 6


def test_short_runs_are_carried_to_the_longest(spark):
    edges = edges_of(spark, ["ab", "bc", "xy"])
    reached = inf.cascades(edges, seeds(spark, [("long", "a"), ("short", "x")]), 1.0, 1, 1)
    curve = inf.mean_curve(inf.cascade_series(reached)).orderBy("strategy", "step").collect()
    assert [r.mean_infected for r in curve] == [1, 2, 3, 1, 2, 2]


def test_seed_choices(spark):
    nodes, edges = nodes_of(spark, "abcdevwxyz"), edges_of(spark, cliques())
    assert [r.id for r in inf.top_degree_seeds(nodes, edges, 2).orderBy("id").collect()] == ["e", "v"]
    greedy = inf.greedy_frontier_seeds(nodes, edges, 3).orderBy("rank").collect()
    assert [r.id for r in greedy] == ["e", "v", "a"]
    assert inf.random_seeds(nodes, 4, 1).distinct().count() == 4
    assert inf.greedy_frontier_seeds(nodes_of(spark, "ab"), edges_of(spark, ["ab"]), 5).count() == 2
    assert inf.seed_count(0.05, 50) == 3


def test_influence_covers_both_cliques(spark):
    pairs = [p for p in cliques() if p != ("e", "v")]
    nodes, edges = nodes_of(spark, "abcdevwxyz"), edges_of(spark, pairs)
    for found in (
        inf.max_influence(nodes, edges, 2, p=0.9, samples=200),
        inf.max_influence_simulated(nodes, edges, 2, p=0.9, runs=10),
    ):
        rows = found.orderBy("rank").collect()
        assert {rows[0].id in "abcde", rows[1].id in "abcde"} == {True, False}
        assert 4 < rows[0].est_spread < rows[1].est_spread <= 10


def test_cover_beats_the_top_degree_bound(spark):
    draw = random.Random(8)
    pairs = {tuple(sorted(draw.sample(range(30), 2))) for _ in range(50)}
    edges = spark.createDataFrame(sorted(pairs), "src int, dst int")
    nodes = g.nodes_of(edges)
    sets = inf.reverse_reachable_sets(nodes, edges, 0.2, 300, 4)
    chosen = inf.max_influence(nodes, edges, 3, 0.2, 300, 4)
    covered = lambda s: sets.join(s.select("id"), "id", "left_semi").select("run").distinct().count()
    assert covered(chosen) >= 0.63 * covered(inf.top_degree_seeds(nodes, edges, 3))


def plain_frontier(pairs, n):
    near = {}
    for a, b in pairs:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    best = lambda ids: min(ids, key=lambda i: (-len(near[i]), i))
    chosen = [best(near)]
    while len(chosen) < n:
        open_nodes = set().union(*(near[i] for i in chosen)) - set(chosen)
        if not open_nodes:
            break
        chosen.append(best(open_nodes))
    return chosen


@pytest.mark.parametrize("batch", [1, 3, 1000])
def test_frontier_takes_many_picks_a_round(spark, batch):
    rng = random.Random(7)
    pairs = sorted({tuple(sorted(rng.sample(range(60), 2))) for _ in range(110)})
    edges = spark.createDataFrame(pairs, "src long, dst long").withColumn("weight", F.lit(1))
    nodes = spark.range(60)
    got = [r.id for r in inf.greedy_frontier_seeds(nodes, edges, 25, batch=batch).orderBy("rank").collect()]
    assert got == plain_frontier(pairs, 25)


@pytest.mark.parametrize("n", [0, 1, 7, 40, 41, 100])
def test_top_rows_with_ties(spark, n):
    rows = [(i, (i * 7) % 5) for i in range(41)]
    got = ranking.top_rows(spark.createDataFrame(rows, "id long, degree long"), "degree", "id", n)
    assert sorted(r.id for r in got.collect()) == sorted(i for i, _ in sorted(rows, key=lambda r: (-r[1], r[0]))[:n])
