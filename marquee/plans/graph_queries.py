"""Embedding space, clusters and the film-person graph."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import clustering as C
from ..operators import graph as G
from ..operators import neighbours as K
from ..operators import resolve as R
from ..operators import serving as V
from ..session import cut_lineage
from .catalog_queries import films
from .page_queries import _LINKS, filmography
from .registry import Tables, query

_ROLES = """roles AS (SELECT person_id, name, film_id, CASE WHEN lower(job) = 'director' THEN 'Director' ELSE 'Cinematographer' END AS role,
        vote_average, vote_count, title FROM film_crew JOIN people USING (person_id) JOIN movies USING (film_id)
        WHERE lower(job) IN ('director', 'director of photography', 'cinematographer') AND vote_count >= 100 AND name IS NOT NULL)"""
_ROLE_VIEWS = "film_crew people movies"


def roles(t: Tables):
    return C.person_film_roles(t.film_crew, t.people, t.movies)


@query(f"WITH {_ROLES} SELECT * FROM roles", _ROLE_VIEWS)
def person_film_roles(t: Tables):
    return roles(t).select("person_id", "name", "film_id", "role", "vote_average", "vote_count", "title")


_POSITIONS = f"""{_ROLES}, positions AS (SELECT person_id, name, max(role) AS role, count(*) AS film_count, round(avg(x), 5) AS x, round(avg(y), 5) AS y,
        min(struct_pack(v := -vote_average, f := film_id, t := title)) AS best FROM roles JOIN film_xy USING (film_id) GROUP BY person_id, name
        HAVING count(*) >= CASE WHEN max(role) = 'Director' THEN 3 ELSE 2 END)"""


@query(f"""WITH {_POSITIONS} SELECT person_id, name, role, film_count, x, y, best.f AS top_film_id, best.t AS top_film_title FROM positions""",
       _ROLE_VIEWS + " film_xy")
def person_positions(t: Tables):
    return positions(t)


def positions(t: Tables):
    return C.person_positions(roles(t), t.film_xy)


@query(f"""WITH {_ROLES} SELECT person_id, film_id AS top_film_id, title AS top_film_title FROM (
    SELECT *, row_number() OVER (PARTITION BY person_id ORDER BY vote_average DESC, film_id) AS rn FROM roles) WHERE rn = 1""", _ROLE_VIEWS)
def top_film_per_person(t: Tables):
    return C.top_film_per_person(roles(t))


@query("""WITH e AS (SELECT label, unnest(embedding)::double AS v, generate_subscripts(embedding, 1) - 1 AS dim FROM embeddings)
    SELECT label, cast(dim AS int) AS dim, round(avg(v), 6) AS mean FROM e GROUP BY label, dim""")
def style_vectors(t: Tables):
    means = C.mean_vectors(t.embeddings, "label", "embedding")
    return means.select("label", F.posexplode("mean_vector").alias("dim", "mean")).withColumn("mean", F.round("mean", 6))


@query(f"""WITH {_ROLES}, e AS (SELECT person_id, unnest(embedding)::double AS v, generate_subscripts(embedding, 1) - 1 AS dim
        FROM (SELECT DISTINCT person_id, film_id FROM roles) JOIN embeddings ON vec_id = film_id)
    SELECT person_id, cast(dim AS int) AS dim, round(avg(v), 6) AS mean FROM e GROUP BY person_id, dim""", _ROLE_VIEWS)
def style_vectors_of_people(t: Tables):
    """The mean embedding of the films of each director and cinematographer."""
    theirs = roles(t).select("person_id", "film_id").distinct().join(t.embeddings.select(F.col("vec_id").alias("film_id"), "embedding"), "film_id")
    means = C.mean_vectors(theirs, "person_id", "embedding")
    return means.select("person_id", F.posexplode("mean_vector").alias("dim", "mean")).withColumn("mean", F.round("mean", 6))


@query(f"""WITH {_POSITIONS} SELECT least(15, count(DISTINCT (x, y)))::int AS clusters, count(*) AS members, sum(film_count)::bigint AS films, true AS settled FROM positions""",
       _ROLE_VIEWS + " film_xy")
def kmeans_clusters(t: Tables):
    """What doesn't depend on the random start: how many clusters and members there are, and that
    the assignment has settled, with every point nearest to the mean of its own cluster."""
    members = cut_lineage(C.kmeans(positions(t), ["x", "y"]))
    means = members.groupBy("cluster").agg(F.avg("x").alias("cx"), F.avg("y").alias("cy"))
    nearest = C.nearest_centroid(members, means, "cluster", out="nearest")
    astray = F.count_if(F.col("nearest") != F.col("cluster"))
    return nearest.agg(
        F.count_distinct("cluster").cast("int").alias("clusters"), F.count("*").alias("members"), F.sum("film_count").alias("films"),
        (astray == 0).alias("settled"),
    )


def _themed(t: Tables):
    """People in the cluster of their most frequent theme's number, fixed for comparison."""
    counted = roles(t).join(t.film_xy.select("film_id", "theme"), "film_id").groupBy("person_id", "name", "theme").agg(F.count("*").alias("c"))
    return counted.groupBy("person_id", "name").agg(F.max(F.struct("c", "theme"))["theme"].alias("cluster"), F.sum("c").alias("film_count"))


@query(f"""WITH {_ROLES}, members AS (SELECT person_id, name, max(struct_pack(c := c, theme := theme)).theme AS cluster FROM (
        SELECT person_id, name, theme, count(*) AS c FROM roles JOIN film_xy USING (film_id) GROUP BY ALL) GROUP BY ALL),
    counted AS (SELECT cluster, genre_name, count(*) AS n FROM film_crew JOIN members USING (person_id) JOIN film_genres USING (film_id) JOIN genres USING (genre_id)
        WHERE lower(job) IN ('director', 'director of photography', 'cinematographer') GROUP BY ALL)
    SELECT cluster, string_agg(genre_name, ' & ' ORDER BY rn) AS cluster_label FROM (
        SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY n DESC, genre_name) AS rn FROM counted) WHERE rn <= 2 GROUP BY cluster""",
       _ROLE_VIEWS + " film_xy film_genres genres")
def cluster_labels(t: Tables):
    return C.cluster_labels(_themed(t), t.film_crew, t.film_genres, t.genres)


@query(f"""WITH {_POSITIONS} SELECT person_id, name, role, film_count, x, y, best.f AS top_film_id, best.t AS top_film_title, true AS labelled FROM positions""",
       _ROLE_VIEWS + " film_xy")
def node_table(t: Tables):
    """Clusters depend on the random start; that each has one label doesn't."""
    members = cut_lineage(C.kmeans(positions(t), ["x", "y"], restarts=3))
    nodes = C.node_table(members, C.cluster_labels(members, t.film_crew, t.film_genres, t.genres))
    return nodes.withColumn("labelled", F.col("cluster_label").isNotNull()).drop("cluster", "cluster_label")


def _lloyd_sql(k: int = 20, rounds: int = 40) -> str:
    """The rounds written out one after the other."""
    steps = [
        f"""p AS MATERIALIZED (SELECT film_id, x, y, row_number() OVER (ORDER BY film_id) - 1 AS pos, count(*) OVER () AS n FROM film_xy),
        c0 AS MATERIALIZED (SELECT i, p.x AS cx, p.y AS cy FROM range({k}) r(i) JOIN p ON p.pos = least(i * (n // {k}), n - 1))"""
    ]
    for i in range(rounds):
        steps.append(
            f"""a{i} AS MATERIALIZED (SELECT film_id, x, y, arg_min(i, struct_pack(d := (x - cx) * (x - cx) + (y - cy) * (y - cy), i := i)) AS i FROM p, c{i} GROUP BY ALL),
            c{i + 1} AS MATERIALIZED (SELECT c.i, coalesce(avg(x), any_value(cx)) AS cx, coalesce(avg(y), any_value(cy)) AS cy FROM c{i} c LEFT JOIN a{i} a ON a.i = c.i GROUP BY c.i)"""
        )
    return f"WITH {', '.join(steps)} SELECT film_id, cast(i AS int) AS cluster FROM a{rounds - 1}"


@query(_lloyd_sql(), "film_xy")
def lloyd_fixed_init(t: Tables):
    return C.lloyd(t.film_xy, "film_id").select("film_id", "cluster")


@query("""SELECT theme, count(*) AS n, round(avg(x), 6) AS cx, round(avg(y), 6) AS cy, round(sqrt(var_pop(x) + var_pop(y)), 6) AS spread
    FROM film_xy GROUP BY theme""", "film_xy")
def centroid_spread(t: Tables):
    regions = C.centroid_spread(t.film_xy, "theme")
    return regions.withColumns({c: F.round(c, 6) for c in ("cx", "cy", "spread")})


@query("""WITH c AS (SELECT theme, avg(x) AS cx, avg(y) AS cy FROM film_xy GROUP BY theme)
    SELECT film_id, arg_min(c.theme, struct_pack(d := (x - cx) * (x - cx) + (y - cy) * (y - cy), t := c.theme)) AS territory FROM film_xy p, c GROUP BY film_id""",
       "film_xy")
def nearest_centroid(t: Tables):
    points = t.film_xy
    return C.nearest_centroid(points, C.centroid_spread(points, "theme"), "theme").select("film_id", "territory")


@query("""SELECT film_id, neighbour, position FROM (SELECT a.film_id, b.film_id AS neighbour, cast(row_number() OVER (PARTITION BY a.film_id
        ORDER BY round(sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)), 9), b.film_id) AS int) AS position
    FROM film_xy a JOIN film_xy b ON a.film_id <> b.film_id) WHERE position <= 8""", "film_xy")
def knn_2d(t: Tables):
    return K.nearest_in_plane(t.film_xy, "film_id", "x", "y", 8).select("film_id", "neighbour", "position")


_EDGES = """sims AS (SELECT a.vec_id AS src, b.vec_id AS dst, round(list_cosine_similarity(a.embedding::double[], b.embedding::double[]), 9) AS sim
        FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id),
    edges AS (SELECT src, dst, sim FROM (SELECT *, row_number() OVER (PARTITION BY src ORDER BY sim DESC, dst) AS rn FROM sims) WHERE rn <= 10)"""


@query(f"WITH {_EDGES} SELECT src, dst, round(sim, 4) AS sim FROM edges")
def thematic_edges(t: Tables):
    return edges(t).withColumn("sim", F.round("sim", 4))


def edges(t: Tables):
    return K.thematic_edges(t.embeddings, "vec_id", "embedding", 10)


@query(f"""WITH {_EDGES}, asked AS (SELECT src, dst, sim FROM edges WHERE src % 50 = 0)
    SELECT src, count(*) AS wanted, round(sum(sim), 3) AS total, true AS recall_reached FROM asked GROUP BY src""")
def thematic_edges_by_lists(t: Tables):
    """Edges over inverted lists, measured: of the vectors whose id is divisible by 50, the exact edges against
    all rows, and whether nine tenths of all of these are found over the lists with the same similarity."""
    asked = edges(t).filter("src % 50 = 0")
    probed = K.thematic_edges(t.embeddings, "vec_id", "embedding", 10, exact=False).select("src", "dst", F.col("sim").alias("found"))
    both = asked.join(probed, ["src", "dst"], "left").withColumn("hit", F.coalesce(F.col("found") == F.col("sim"), F.lit(False)).cast("int"))
    each = cut_lineage(both.groupBy("src").agg(F.count("*").alias("wanted"), F.round(F.sum("sim"), 3).alias("total"), F.sum("hit").alias("hits")))
    reached = each.agg(F.sum("hits") >= 0.9 * F.sum("wanted")).first()[0]
    return each.select("src", "wanted", "total", F.lit(reached).cast("boolean").alias("recall_reached"))


_BOTH = f"""{_EDGES}, both_ways AS (SELECT src, dst, max(sim) AS sim FROM (SELECT src, dst, sim FROM edges UNION ALL SELECT dst, src, sim FROM edges) GROUP BY ALL)"""


@query(f"WITH {_BOTH} SELECT src, dst, round(sim, 4) AS sim FROM both_ways")
def edges_symmetric(t: Tables):
    return K.symmetric_edges(edges(t)).withColumn("sim", F.round("sim", 4))


@query(f"""WITH {_BOTH} SELECT src, dst, position FROM (
    SELECT *, cast(row_number() OVER (PARTITION BY src ORDER BY sim DESC, dst) AS int) AS position FROM both_ways) WHERE position <= 4""")
def top_neighbours(t: Tables):
    return K.top_neighbours(edges(t)).select("src", "dst", "position")


# ---- ego graphs ----------------------------------------------------------------------------


def _ego(t: Tables) -> G.EgoParts:
    """The parts over the catalogue's tables, which are derived once and stored."""
    movies, crew, spine = cut_lineage(t.movies), cut_lineage(t.film_crew), cut_lineage(films(t))
    genres_of = t.film_genres
    links = V.crew_connections(crew, t.people, movies, R.key_bridge(spine))
    adapted = V.co_adaptations(t.based_on, spine)
    return G.EgoParts(movies, links, adapted, genres_of, t.genres, V.related_by_genre(movies, genres_of), t.film_cast, crew, t.people)


_AROUND = f"""{_LINKS}, conns AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY center_id, person_id ORDER BY vote_average DESC, film_id) AS rn FROM links) WHERE rn <= 5),
    k AS (SELECT DISTINCT s.film_id, source_wikidata_id AS source_id, source_label, title, year FROM based_on JOIN spine s ON tconst = imdb_id),
    adapt AS (SELECT * FROM (SELECT a.film_id AS center_id, a.source_id, a.source_label, b.film_id, b.title, b.year,
            row_number() OVER (PARTITION BY a.film_id ORDER BY a.source_label, b.year, b.film_id, a.source_id) AS rn
        FROM k a JOIN k b ON a.source_id = b.source_id AND a.film_id <> b.film_id) WHERE rn <= 60),
    lone AS (SELECT film_id AS center_id FROM movies WHERE film_id NOT IN (SELECT center_id FROM conns)),
    tags AS (SELECT l.center_id, genre_id, genre_name FROM lone l JOIN film_genres f ON f.film_id = l.center_id JOIN genres USING (genre_id)),
    rel AS (SELECT * FROM (SELECT p.center_id, m.film_id, title, row_number() OVER (PARTITION BY p.center_id ORDER BY vote_count DESC, m.film_id) AS rn
        FROM (SELECT DISTINCT a.film_id AS center_id, b.film_id FROM film_genres a JOIN film_genres b USING (genre_id) WHERE a.film_id <> b.film_id) p
        JOIN movies m ON m.film_id = p.film_id JOIN lone l ON l.center_id = p.center_id WHERE vote_count >= 500) WHERE rn <= 15),
    billed AS (SELECT film_id AS center_id, person_id, name, character FROM (
        SELECT *, row_number() OVER (PARTITION BY film_id ORDER BY cast_order, person_id, character) AS rn FROM film_cast) JOIN people USING (person_id) WHERE rn <= 10),
    staff AS (SELECT film_id AS center_id, person_id, name, job FROM film_crew JOIN people USING (person_id)
        WHERE job IN ('Director', 'Screenplay', 'Writer', 'Director of Photography', 'Original Music Composer'))"""
_AROUND_VIEWS = "films_raw basics film_crew people movies based_on film_genres genres film_cast"
_NODES = """all_nodes AS (
    SELECT film_id AS center_id, 'film_' || film_id AS node_id, 0 AS o, 'center' AS kind, title || ' (' || coalesce(left(release_date::string, 4), '') || ')' AS label, NULL::string AS role FROM movies
    UNION ALL SELECT center_id, 'person_' || person_id, 1, 'crew_bridge', person_name, role FROM conns
    UNION ALL SELECT center_id, 'crew_film_' || film_id, 2, 'crew_film', title || ' (' || coalesce(year, '') || ')', NULL FROM conns
    UNION ALL SELECT center_id, 'source_' || source_id, 3, 'source', source_label, NULL FROM adapt
    UNION ALL SELECT center_id, 'source_film_' || film_id, 4, 'source_film', title || ' (' || coalesce(year::string, '') || ')', NULL FROM adapt
    UNION ALL SELECT center_id, 'genre_' || genre_id, 5, 'genre', genre_name, NULL FROM tags
    UNION ALL SELECT center_id, 'film_' || film_id, 6, 'related', title, NULL FROM rel
    UNION ALL SELECT center_id, 'person_' || person_id, 7, 'person', name, character FROM billed
    UNION ALL SELECT center_id, 'person_' || person_id, 8, 'person', name, job FROM staff),
    nodes AS (SELECT center_id, node_id, kind, label, role FROM (
        SELECT *, row_number() OVER (PARTITION BY center_id, node_id ORDER BY o, label, role NULLS FIRST) AS rn FROM all_nodes) WHERE rn = 1)"""


@query(f"WITH {_AROUND}, {_NODES} SELECT * FROM nodes", _AROUND_VIEWS)
def ego_nodes(t: Tables):
    return G.ego_nodes(_ego(t))


@query(f"""WITH {_AROUND}
    SELECT DISTINCT center_id, 'film_' || center_id AS source, 'person_' || person_id AS target, role AS label FROM conns
    UNION SELECT center_id, 'person_' || person_id, 'crew_film_' || film_id, NULL FROM conns
    UNION SELECT center_id, 'film_' || center_id, 'source_' || source_id, NULL FROM adapt
    UNION SELECT center_id, 'source_' || source_id, 'source_film_' || film_id, NULL FROM adapt
    UNION SELECT center_id, 'film_' || center_id, 'genre_' || genre_id, NULL FROM tags
    UNION SELECT r.center_id, 'genre_' || g, 'film_' || film_id, NULL FROM rel r JOIN (SELECT center_id, min(genre_id) AS g FROM tags GROUP BY 1) USING (center_id)
    UNION SELECT center_id, 'film_' || center_id, 'person_' || person_id, NULL FROM billed
    UNION SELECT center_id, 'film_' || center_id, 'person_' || person_id, job FROM staff""", _AROUND_VIEWS)
def ego_edges(t: Tables):
    return G.ego_edges(_ego(t))


@query(f"""WITH {_AROUND}, {_NODES},
    c AS (SELECT film_id, person_id, job, NULL::string AS character FROM film_crew WHERE job <> 'Editor' UNION SELECT film_id, person_id, NULL, character FROM film_cast),
    work AS (SELECT DISTINCT person_id, film_id, title, year FROM (SELECT c.person_id, c.film_id, title, left(release_date::string, 4) AS year, row_number() OVER (PARTITION BY c.person_id
        ORDER BY release_date DESC NULLS LAST, c.film_id, job NULLS LAST, character NULLS LAST) AS rn FROM c JOIN movies m ON m.film_id = c.film_id WHERE vote_count >= 200) WHERE rn <= 10)
    SELECT center_id, 'pfilm_' || film_id AS node_id, min(title || ' (' || coalesce(year, '') || ')') AS label, count(*) AS people
    FROM nodes JOIN work ON node_id = 'person_' || person_id GROUP BY center_id, film_id""", _AROUND_VIEWS)
def ego_expand(t: Tables):
    return G.ego_expand(G.ego_nodes(_ego(t)), filmography(t))


# ---- paths, hubs, recommendations ------------------------------------------------------------


#: Film to film over shared people from the smallest film, until no new film is found.
_BFS = """r(film_id, hops) USING KEY (film_id) AS (
        SELECT min(film_id), 0 FROM credits
        UNION SELECT b.film_id, min(r.hops) + 1 FROM r JOIN credits a USING (film_id) JOIN credits b ON a.person_id = b.person_id
            LEFT JOIN recurring.r k ON k.film_id = b.film_id WHERE k.film_id IS NULL GROUP BY b.film_id)"""


@query(f"WITH RECURSIVE {_BFS} SELECT film_id, cast(hops AS int) AS hops FROM r", "credits")
def shortest_paths(t: Tables):
    credits = t.credits
    start = credits.agg(F.min("film_id").alias("film_id"))
    return G.shortest_hops(credits, start).select("film_id", "hops")


@query(f"""WITH RECURSIVE {_BFS},
    step AS MATERIALIZED (SELECT x.film_id, x.hops, min(struct_pack(p := b.person_id, f := b.film_id)) AS s FROM r x JOIN credits a USING (film_id)
        JOIN credits b ON a.person_id = b.person_id JOIN r y ON y.film_id = b.film_id AND y.hops = x.hops - 1 GROUP BY ALL),
    back(target_id, film_id, hops, via_person, from_film) AS (
        SELECT film_id, film_id, hops, s.p, s.f FROM step
        UNION ALL SELECT target_id, step.film_id, step.hops, s.p, s.f FROM back JOIN step ON step.film_id = back.from_film)
    SELECT r0.film_id AS start_id, target_id, cast(hops AS int) AS step, b.film_id, via_person FROM (
        SELECT target_id, hops, film_id, via_person FROM back
        UNION ALL SELECT film_id, 0, (SELECT film_id FROM r WHERE hops = 0), NULL FROM r) b, (SELECT film_id FROM r WHERE hops = 0) r0""", "credits")
def connection_paths(t: Tables):
    """How every reachable film is connected with the first one, step by step."""
    credits = t.credits
    start = credits.agg(F.min("film_id").alias("film_id"))
    reached = cut_lineage(G.shortest_hops(credits, start))
    return G.connection_paths(reached, reached.select("start_id", F.col("film_id").alias("target_id")))


@query("""SELECT c.person_id, count(*) AS degree, count(DISTINCT theme) AS clusters_bridged FROM credits c LEFT JOIN film_xy x ON x.film_id = c.film_id GROUP BY c.person_id""",
       "credits film_xy")
def hub_scores(t: Tables):
    return G.hub_scores(t.credits, t.film_xy.withColumnRenamed("theme", "cluster"))


_SHARED = """reasons AS (SELECT film_id, 'person ' || person_id AS reason FROM credits
        UNION ALL SELECT o_orderkey, 'customer ' || o_custkey FROM orders),
    rated AS (SELECT o_orderkey AS film_id, o_totalprice AS vote_average FROM orders)"""


def _reasons(t: Tables):
    text = lambda kind, c: F.concat(F.lit(f"{kind} "), F.col(c).cast("string")).alias("reason")
    people = t.credits.select("film_id", text("person", "person_id"))
    return people.unionByName(t.orders.select(F.col("o_orderkey").alias("film_id"), text("customer", "o_custkey")))


@query(f"""WITH {_SHARED}, pairs AS (SELECT a.film_id, b.film_id AS recommended_id, count(*) AS shared, string_agg(a.reason, '|' ORDER BY a.reason) AS reasons
        FROM reasons a JOIN reasons b ON a.reason = b.reason AND a.film_id <> b.film_id GROUP BY ALL)
    SELECT film_id, recommended_id, vote_average, shared, reasons, cast(rn AS int) AS position FROM (
        SELECT p.*, vote_average, row_number() OVER (PARTITION BY p.film_id ORDER BY vote_average DESC, recommended_id) AS rn
        FROM pairs p JOIN rated r ON r.film_id = p.recommended_id) WHERE rn <= 10""", "credits")
def recommend(t: Tables):
    rated = t.orders.select(F.col("o_orderkey").alias("film_id"), F.col("o_totalprice").alias("vote_average"))
    return G.recommend(_reasons(t), rated).withColumn("reasons", F.array_join("reasons", "|"))


@query(f"""WITH {_SHARED}, pairs AS (SELECT DISTINCT a.film_id, b.film_id AS recommended_id FROM reasons a JOIN reasons b ON a.reason = b.reason AND a.film_id <> b.film_id),
    top AS (SELECT p.film_id, recommended_id FROM (SELECT p.*, row_number() OVER (PARTITION BY p.film_id ORDER BY vote_average DESC, recommended_id) AS rn
        FROM pairs p JOIN rated r ON r.film_id = p.recommended_id) p WHERE rn <= 10)
    SELECT DISTINCT t.film_id, recommended_id, a.reason FROM top t JOIN reasons a ON a.film_id = t.film_id JOIN reasons b ON b.film_id = recommended_id AND a.reason = b.reason""", "credits")
def recommend_reasons(t: Tables):
    """Everything that recommended films share with the film they are recommended for."""
    rated = t.orders.select(F.col("o_orderkey").alias("film_id"), F.col("o_totalprice").alias("vote_average"))
    relations = _reasons(t)
    return G.recommendation_reasons(relations, G.recommend(relations, rated))
