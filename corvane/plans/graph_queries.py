"""Graph jobs on the part graph (parts ordered together at least twice) and the mention graph."""

from __future__ import annotations

from pyspark.sql import functions as F

from corvane.functions.keyed_random import uniform_sql
from corvane.operators import communities, graph_stats as g, influence as inf, shells
from corvane.operators.ranking import hash_rank
from corvane.plans.registry import query
from corvane.plans.tables import mention_graph, part_communities, part_graph
from corvane.plans.text_queries import MENTION_EDGES_SQL, MENTIONS_SQL

EDGES = """
items AS (SELECT DISTINCT l_orderkey AS g, l_partkey AS i FROM lineitem),
edges AS MATERIALIZED (SELECT a.i AS src, b.i AS dst, count(*) AS weight
          FROM items a JOIN items b ON a.g = b.g AND a.i < b.i GROUP BY 1, 2 HAVING count(*) >= 2),
sym AS MATERIALIZED (SELECT src, dst FROM edges UNION ALL SELECT dst, src FROM edges),
nodes AS (SELECT DISTINCT src AS id FROM sym),
degs AS MATERIALIZED (SELECT src AS id, count(*) AS degree FROM sym GROUP BY 1)"""
PARTS = "parts AS (SELECT p_partkey AS id, p_brand AS community FROM part)"
CROSS = """placed AS (SELECT e.src, e.dst, a.community AS ca, b.community AS cb
                      FROM edges e JOIN parts a ON a.id = e.src JOIN parts b ON b.id = e.dst)"""

SEEDS, RUNS, P, SEED = 3, 50, 0.2, 17
# the walks of the SQL can go round in circles, so they need an end; it lies far beyond the longest cascade
SQL_STEPS = 60


@query("part_graph_edges", f"WITH {EDGES} SELECT src, dst, weight FROM edges")
def part_graph_edges(spark, folder):
    return part_graph(spark, folder)[1]


@query("degree_table", f"WITH {EDGES} SELECT id, degree FROM degs")
def degree_table(spark, folder):
    return g.by_degree(*part_graph(spark, folder))


@query(
    "degree_stats",
    f"""WITH {EDGES} SELECT count(*) AS n_nodes, round(avg(degree), 6) AS mean_degree,
                            round(var_pop(degree), 6) AS var_degree FROM degs""",
)
def degree_stats(spark, folder):
    return g.degree_stats(*part_graph(spark, folder)).select(
        "n_nodes", F.round("mean_degree", 6).alias("mean_degree"), F.round("var_degree", 6).alias("var_degree")
    )


@query(
    "degree_assortativity",
    f"""WITH {EDGES} SELECT round(corr(CAST(a.degree AS DOUBLE), CAST(b.degree AS DOUBLE)), 6) AS assortativity
        FROM sym s JOIN degs a ON a.id = s.src JOIN degs b ON b.id = s.dst""",
)
def degree_assortativity(spark, folder):
    _, edges = part_graph(spark, folder)
    return g.degree_assortativity(edges).select(F.round("assortativity", 6).alias("assortativity"))


@query("neighbours", f"WITH {EDGES} SELECT src AS id, dst AS neighbour FROM sym")
def neighbours(spark, folder):
    return g.neighbours(part_graph(spark, folder)[1])


def _shell_sql(rounds: int) -> str:
    """h-index rounds written out; more rounds than needed do no harm."""
    steps = ["c0 AS MATERIALIZED (SELECT id, degree AS core FROM degs)"]
    for i in range(1, rounds + 1):
        steps.append(
            f"""c{i} AS MATERIALIZED (SELECT id, max(least(r, core)) AS core FROM
                  (SELECT s.src AS id, c.core, row_number() OVER (PARTITION BY s.src ORDER BY c.core DESC) AS r
                   FROM sym s JOIN c{i - 1} c ON c.id = s.dst) GROUP BY id)"""
        )
    return f"WITH {EDGES}, {', '.join(steps)} "


SHELL_ROUNDS = 30


@query("k_shells", _shell_sql(SHELL_ROUNDS) + f"SELECT id, CAST(core AS BIGINT) AS shell FROM c{SHELL_ROUNDS}")
def k_shells(spark, folder):
    return shells.k_shells(*part_graph(spark, folder))


@query(
    "shell_table",
    _shell_sql(SHELL_ROUNDS)
    + f""", s AS (SELECT CAST(core AS BIGINT) AS shell, count(*) AS n FROM c{SHELL_ROUNDS} GROUP BY 1)
          SELECT a.shell, coalesce(s.n, 0) AS n
          FROM (SELECT unnest(range(0, (SELECT max(shell) + 1 FROM s))) AS shell) a LEFT JOIN s USING (shell)""",
)
def shell_table(spark, folder):
    return shells.shell_table(shells.k_shells(*part_graph(spark, folder)))


@query("crossing_edges", f"WITH {EDGES}, {PARTS}, {CROSS} SELECT src, dst, ca AS c_src, cb AS c_dst FROM placed WHERE ca <> cb")
def crossing_edges(spark, folder):
    found = g.crossing_edges(part_graph(spark, folder)[1], part_communities(spark, folder))
    return found.select("src", "dst", "c_src", "c_dst")


@query(
    "intercommunity_edges",
    f"""WITH {EDGES}, {PARTS}, {CROSS} SELECT least(ca, cb) AS src, greatest(ca, cb) AS dst, count(*) AS weight
        FROM placed WHERE ca <> cb GROUP BY 1, 2""",
)
def intercommunity_edges(spark, folder):
    return g.quotient_graph(part_graph(spark, folder)[1], part_communities(spark, folder))


@query(
    "community_members",
    f"WITH {PARTS} SELECT community, count(*) OVER (PARTITION BY community) AS size, id FROM parts",
)
def community_members(spark, folder):
    return g.community_members(part_communities(spark, folder)).orderBy("id")


@query("community_count", f"WITH {PARTS} SELECT count(DISTINCT community) AS n_communities FROM parts")
def community_count(spark, folder):
    return g.community_count(part_communities(spark, folder))


@query(
    "induced_subgraph",
    f"""WITH {EDGES} SELECT src, dst, weight FROM edges
        SEMI JOIN (SELECT id AS src FROM degs WHERE degree >= 4) USING (src)
        SEMI JOIN (SELECT id AS dst FROM degs WHERE degree >= 4) USING (dst)""",
)
def induced_subgraph(spark, folder):
    nodes, edges = part_graph(spark, folder)
    return g.induced_subgraph(edges, g.degrees(nodes, edges).filter("degree >= 4"))


@query(
    "modularity",
    f"""WITH {EDGES}, {PARTS}, {CROSS}, m AS (SELECT CAST(count(*) AS DOUBLE) AS m FROM placed),
             inside AS (SELECT ca AS c, count(*) AS n FROM placed WHERE ca = cb GROUP BY 1),
             tot AS (SELECT c, count(*) AS n FROM (SELECT ca AS c FROM placed UNION ALL SELECT cb FROM placed) GROUP BY 1)
        SELECT round(sum(coalesce(i.n, 0) / m.m - (t.n / (2 * m.m)) * (t.n / (2 * m.m))), 6) AS modularity
        FROM tot t LEFT JOIN inside i USING (c), m""",
)
def modularity(spark, folder):
    found = g.modularity(part_graph(spark, folder)[1], part_communities(spark, folder))
    return found.select(F.round("modularity", 6).alias("modularity"))


@query("louvain")
def louvain(spark, folder):
    nodes, edges = part_graph(spark, folder)
    return communities.final_partition(communities.louvain(nodes, edges))


@query("top_degree_seeds", f"WITH {EDGES} SELECT id, degree FROM degs ORDER BY degree DESC, id LIMIT {SEEDS}")
def top_degree_seeds(spark, folder):
    return inf.top_degree_seeds(*part_graph(spark, folder), SEEDS)


_RANDOM = f"(SELECT id FROM nodes ORDER BY {uniform_sql(SEED, 'id')}, id LIMIT {SEEDS})"


@query("random_seeds", f"WITH {EDGES} SELECT id FROM {_RANDOM}")
def random_seeds(spark, folder):
    return inf.random_seeds(part_graph(spark, folder)[0], SEEDS, SEED)


def _frontier_sql(n: int) -> str:
    steps = ["f1 AS MATERIALIZED (SELECT id, degree, 1 AS rank FROM degs ORDER BY degree DESC, id LIMIT 1)"]
    for i in range(2, n + 1):
        steps.append(
            f"""f{i} AS MATERIALIZED (SELECT id, degree, rank FROM f{i - 1} UNION ALL
                 (SELECT id, degree, {i} FROM degs WHERE id IN (SELECT s.dst FROM sym s JOIN f{i - 1} f ON f.id = s.src)
                    AND id NOT IN (SELECT id FROM f{i - 1}) ORDER BY degree DESC, id LIMIT 1))"""
        )
    return ", ".join(steps)


@query("greedy_frontier_seeds", f"WITH {EDGES}, {_frontier_sql(SEEDS)} SELECT rank, id, degree FROM f{SEEDS}")
def greedy_frontier_seeds(spark, folder):
    return inf.greedy_frontier_seeds(*part_graph(spark, folder), SEEDS)


def strategy_seeds(nodes, edges):
    """The three ways to choose seeds that are compared."""
    named = lambda df, name: df.select(F.lit(name).alias("strategy"), "id")
    return (
        named(inf.random_seeds(nodes, SEEDS, SEED), "random")
        .unionByName(named(inf.top_degree_seeds(nodes, edges, SEEDS), "degree"))
        .unionByName(named(inf.greedy_frontier_seeds(nodes, edges, SEEDS), "greedy"))
    )


def _cascade_sql() -> str:
    return f"""WITH RECURSIVE {EDGES}, {_frontier_sql(SEEDS)},
        seeds AS (SELECT 'random' AS strategy, id FROM {_RANDOM}
                  UNION ALL SELECT 'degree', id FROM (SELECT id FROM degs ORDER BY degree DESC, id LIMIT {SEEDS})
                  UNION ALL SELECT 'greedy', id FROM f{SEEDS}),
        live AS MATERIALIZED (SELECT run, src, dst FROM sym, range(1, {RUNS + 1}) r(run)
                 WHERE {uniform_sql(SEED, 'run', 'src', 'dst')} < {P}),
        walk AS (SELECT strategy, run, id, 0 AS step FROM seeds, range(1, {RUNS + 1}) r(run)
                 UNION
                 SELECT w.strategy, w.run, l.dst, w.step + 1 FROM walk w
                 JOIN live l ON l.run = w.run AND l.src = w.id WHERE w.step < {SQL_STEPS}),
        reached AS (SELECT strategy, run, id, min(step) AS step FROM walk GROUP BY 1, 2, 3)"""


def _reached(spark, folder):
    nodes, edges = part_graph(spark, folder)
    return inf.cascades(edges, strategy_seeds(nodes, edges), P, RUNS, SEED)


@query("cascade_reached", f"{_cascade_sql()} SELECT strategy, CAST(run AS INTEGER) AS run, id, step FROM reached")
def cascade_reached(spark, folder):
    return _reached(spark, folder)


@query(
    "cascade_curve",
    f"""{_cascade_sql()}, fresh AS (SELECT strategy, run, step, count(*) AS n FROM reached GROUP BY 1, 2, 3),
        steps AS (SELECT DISTINCT f.strategy, f.run, s.step
                  FROM fresh f, (SELECT unnest(range(0, (SELECT max(step) + 1 FROM fresh))) AS step) s)
        SELECT strategy, CAST(step AS INTEGER) AS step, round(avg(infected), 6) AS mean_infected FROM
          (SELECT strategy, run, step, sum(coalesce(n, 0)) OVER (PARTITION BY strategy, run ORDER BY step) AS infected
           FROM steps LEFT JOIN fresh USING (strategy, run, step)) GROUP BY 1, 2""",
)
def cascade_curve(spark, folder):
    curve = inf.mean_curve(inf.cascade_series(_reached(spark, folder)))
    return curve.withColumn("mean_infected", F.round("mean_infected", 6))


@query(
    "cascade_strategy_stats",
    f"""{_cascade_sql()} SELECT strategy, round(avg(size), 6) AS mean_size, round(var_pop(size), 6) AS var_size,
               max(longest) AS longest
        FROM (SELECT strategy, run, count(*) AS size, max(step) AS longest FROM reached GROUP BY 1, 2) GROUP BY 1""",
)
def cascade_strategy_stats(spark, folder):
    return inf.strategy_stats(_reached(spark, folder)).select(
        "strategy", F.round("mean_size", 6).alias("mean_size"), F.round("var_size", 6).alias("var_size"), "longest"
    )


SAMPLES, SPREAD_P, SPREAD_RUNS = 2000, 0.1, 100
_MENTION_GRAPH = f"""{MENTIONS_SQL}, {MENTION_EDGES_SQL},
    msym AS MATERIALIZED (SELECT src, dst FROM medges UNION ALL SELECT dst, src FROM medges),
    mnodes AS MATERIALIZED (SELECT DISTINCT entity AS id FROM mentions)"""


def _live_sql(runs: int) -> str:
    return f"""live AS MATERIALIZED (SELECT run, src, dst FROM msym, range(1, {runs + 1}) r(run)
               WHERE {uniform_sql(SEED, 'run', 'src', 'dst')} < {SPREAD_P})"""


def _cover_sql(n: int) -> str:
    """Greedy cover of the sets of nodes that reach a drawn target."""
    steps = [
        f"""numbered AS (SELECT id, row_number() OVER (ORDER BY {uniform_sql(SEED, 'id')}, id) AS rank FROM mnodes),
            drawn AS (SELECT run, CAST(floor({uniform_sql(SEED + 1, 'run')} * (SELECT count(*) FROM mnodes)) AS BIGINT) + 1 AS rank
                      FROM range(1, {SAMPLES + 1}) r(run)),
            walk AS (SELECT run, id FROM drawn JOIN numbered USING (rank)
                     UNION SELECT w.run, l.dst FROM walk w JOIN live l ON l.run = w.run AND l.src = w.id),
            left1 AS MATERIALIZED (SELECT run, id FROM walk)"""
    ]
    for i in range(1, n + 1):
        steps.append(
            f"""best{i} AS MATERIALIZED (SELECT id, count(*) AS covered FROM left{i} GROUP BY id ORDER BY covered DESC, id LIMIT 1),
                left{i + 1} AS MATERIALIZED (SELECT run, id FROM left{i} WHERE run NOT IN
                  (SELECT run FROM left{i} WHERE id IN (SELECT id FROM best{i})))"""
        )
    chosen = " UNION ALL ".join(f"SELECT CAST({i} AS INTEGER) AS rank, id, covered FROM best{i}" for i in range(1, n + 1))
    return f"""WITH RECURSIVE {_MENTION_GRAPH}, {_live_sql(SAMPLES)}, {', '.join(steps)}
               SELECT rank, id, round(sum(covered) OVER (ORDER BY rank) * (SELECT count(*) FROM mnodes) / {SAMPLES}.0, 6) AS est_spread
               FROM ({chosen})"""


def _climb_sql(n: int) -> str:
    """Hill climbing: every open node is tried together with the nodes chosen before."""
    steps, taken = [], []
    for i in range(1, n + 1):
        seeds = "SELECT id AS strategy, id FROM mnodes" + "".join(
            f" UNION ALL SELECT n.id, b.id FROM mnodes n, best{j} b" for j in taken
        )
        closed = "".join(f" AND strategy NOT IN (SELECT id FROM best{j})" for j in taken)
        steps.append(
            f"""walk{i} AS (SELECT strategy, run, id FROM ({seeds}), range(1, {SPREAD_RUNS + 1}) r(run)
                  UNION SELECT w.strategy, w.run, l.dst FROM walk{i} w JOIN live l ON l.run = w.run AND l.src = w.id),
                best{i} AS MATERIALIZED (SELECT strategy AS id, count(*) / {SPREAD_RUNS}.0 AS est_spread FROM walk{i}
                  WHERE TRUE{closed} GROUP BY strategy ORDER BY est_spread DESC, strategy LIMIT 1)"""
        )
        taken.append(i)
    chosen = " UNION ALL ".join(f"SELECT CAST({i} AS INTEGER) AS rank, id, round(est_spread, 6) AS est_spread FROM best{i}" for i in taken)
    return f"WITH RECURSIVE {_MENTION_GRAPH}, {_live_sql(SPREAD_RUNS)}, {', '.join(steps)} {chosen}"


@query("influence_hill_climb", _cover_sql(SEEDS))
def influence_hill_climb(spark, folder):
    """Seeds by covering reverse-reachable sets."""
    found = inf.max_influence(*mention_graph(spark, folder), SEEDS, p=SPREAD_P, samples=SAMPLES, seed=SEED)
    return found.withColumn("est_spread", F.round("est_spread", 6))


@query("influence_simulated", _climb_sql(SEEDS))
def influence_simulated(spark, folder):
    """Seeds by simulating every candidate."""
    found = inf.max_influence_simulated(
        *mention_graph(spark, folder), SEEDS, p=SPREAD_P, runs=SPREAD_RUNS, seed=SEED
    )
    return found.withColumn("est_spread", F.round("est_spread", 6))


@query(
    "sample_nodes",
    f"""WITH {EDGES} SELECT id, row_number() OVER (ORDER BY {uniform_sql(5, 'id')}, id) AS rank FROM nodes""",
)
def sample_nodes(spark, folder):
    """The order in which nodes would be drawn without replacement."""
    return hash_rank(part_graph(spark, folder)[0], ["id"], 5)


