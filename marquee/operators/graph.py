"""Neighbourhoods, paths, hubs and recommendations on the film-person graph."""

from __future__ import annotations

import functools
import itertools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import titled_year, typed_null, year_text
from ..session import cut_lineage
from . import skew
from .serving import GRAPH_JOBS, leading_films, profile_cast, profile_crew
from .skew import dealt_to_unfold, hot_keys, skew_join, top_per_group


def _node_id(kind: str, key: str) -> Column:
    return F.concat(F.lit(f"{kind}_"), F.col(key).cast("string"))


#: Nodes or edges of an ego graph, about, before repeats are dropped.
AROUND = 200
#: Graphs of a person in one list, about.
LISTED = 10_000
_NODE = "array<struct<node_id:string,first:struct<order:int,kind:string,label:string,role:string>>>"
_EDGE = "array<struct<source:string,target:string,label:string>>"


def _node(order: int, kind: str, node: Column, label: Column, role: Column | None = None) -> Column:
    first = F.struct(F.lit(order).alias("order"), F.lit(kind).alias("kind"), label.alias("label"), (typed_null("string") if role is None else role).alias("role"))
    return F.struct(node.alias("node_id"), first.alias("first"))


def _edge(source: Column, target: Column, label: Column | None = None) -> Column:
    return F.struct(source.alias("source"), target.alias("target"), (typed_null("string") if label is None else label).alias("label"))


class EgoParts:
    """What every film's ego graph is drawn from, all films at once.

    Genre and related-film nodes appear only around films without crew connections, which
    are stored, as they are read for that too.
    """

    def __init__(self, films, connections, adaptations, film_genres, genres, related, cast, crew, people):
        self.films = films.select(F.col("film_id").alias("center_id"), "title", "release_date")
        self.connections = cut_lineage(connections)
        self.adaptations = adaptations
        with_crew = self.connections.select("center_id").distinct()
        named = film_genres.withColumnRenamed("film_id", "center_id").join(genres.withColumn("_known", F.lit(True)), "genre_id", "left")
        tags = named.withColumn("_known", F.coalesce("_known", F.lit(False))).join(with_crew, "center_id", "left_anti")
        self.related = related.withColumnRenamed("film_id", "other_id").select("center_id", "other_id", F.col("title").alias("other_title"))
        # One row per genre; the first known genre of a film carries its related films.
        mine = Window.partitionBy("center_id").orderBy(F.desc("_known"), "genre_id", "genre_name")
        lists = self.related.groupBy("center_id").agg(F.collect_list(F.struct("other_id", "other_title")).alias("others"))
        self.genres = tags.withColumn("_first", F.row_number().over(mine) == 1).join(lists, "center_id", "left")
        self.cast = profile_cast(cast, people, 10).withColumnRenamed("film_id", "center_id")
        self.crew = profile_crew(crew, people, GRAPH_JOBS).withColumnRenamed("film_id", "center_id")

    def entries(self) -> DataFrame:
        """``center_id, nodes, edges``: what each row of each part adds to a graph; every part is read once."""
        center, person = _node_id("film", "center_id"), _node_id("person", "person_id")
        label = F.concat(F.col("title"), F.lit(" ("), F.coalesce(F.col("year").cast("string"), F.lit("")), F.lit(")"))
        source, genre = _node_id("source", "source_wikidata_id"), _node_id("genre", "genre_id")
        others, known = F.when(F.col("_first"), F.col("others")), F.col("_known")
        other_id = lambda o: F.concat(F.lit("film_"), o["other_id"].cast("string"))
        no_node, no_edge = F.array().cast(_NODE), F.array().cast(_EDGE)
        parts = [
            (self.films, F.array(_node(0, "center", center, titled_year("title", "release_date"))), no_edge),
            (
                self.connections,
                F.array(_node(1, "crew_bridge", person, F.col("person_name"), F.col("role")), _node(2, "crew_film", _node_id("crew_film", "film_id"), label)),
                F.array(_edge(center, person, F.col("role")), _edge(person, _node_id("crew_film", "film_id"))),
            ),
            (
                self.adaptations,
                F.array(_node(3, "source", source, F.col("source_label")), _node(4, "source_film", _node_id("source_film", "film_id"), label)),
                F.array(_edge(center, source), _edge(source, _node_id("source_film", "film_id"))),
            ),
            (
                self.genres,
                F.concat(
                    F.when(known, F.array(_node(5, "genre", genre, F.col("genre_name")))).otherwise(no_node),
                    F.coalesce(F.transform(others, lambda o: _node(6, "related", other_id(o), o["other_title"])), no_node),
                ),
                F.when(known, F.concat(F.array(_edge(center, genre)), F.coalesce(F.transform(others, lambda o: _edge(genre, other_id(o))), no_edge))).otherwise(no_edge),
            ),
            (self.cast, F.array(_node(7, "person", person, F.col("name"), F.col("character"))), F.array(_edge(center, person))),
            (self.crew, F.array(_node(8, "person", person, F.col("name"), F.col("job"))), F.array(_edge(center, person, F.col("job")))),
        ]
        made = [df.select("center_id", nodes.cast(_NODE).alias("nodes"), edges.cast(_EDGE).alias("edges")) for df, nodes, edges in parts]
        return functools.reduce(DataFrame.unionByName, made)

    def unfolded(self, column: str, early: bool = False) -> DataFrame:
        """The entries' nodes or edges, one row each, those of a film in one task, so that repeats need no further shuffle.
        ``early`` ones unfold before they are sent: of those, only the kinds and columns that are read further on are sent."""
        unfold = lambda df: df.select("center_id", F.inline(column))
        entries = self.entries().select("center_id", column)
        met = dealt_to_unfold(unfold(entries) if early else entries, "center_id", self.films.count() * AROUND)
        return met if early else unfold(met)


def ego_nodes(p: EgoParts) -> DataFrame:
    """Typed nodes per film; a node reached in several ways keeps the first kind."""
    every = p.unfolded("nodes", early=True)
    return (
        every.groupBy("center_id", "node_id")
        .agg(F.min("first").alias("f"))
        .select("center_id", "node_id", F.col("f.kind").alias("kind"), F.col("f.label").alias("label"), F.col("f.role").alias("role"))
    )


def ego_edges(p: EgoParts) -> DataFrame:
    return p.unfolded("edges").distinct()


def _centers_by_person(people: DataFrame, asked: DataFrame) -> DataFrame:
    """``person_id, centers``: the graphs each person is in, as lists of ``LISTED`` or so."""
    chunk = F.pmod(F.xxhash64("center_id"), F.ceil(F.col("_centers") / LISTED)).alias("_chunk")
    # A list leaves nulls out, so graphs without an id have lists of their own.
    none = F.array_repeat(F.lit(None).cast(people.schema["center_id"].dataType), F.count("*").cast("int"))
    return (
        skew_join(people, asked, ["person_id"])
        .groupBy("person_id", chunk, F.col("center_id").isNull())
        .agg(F.when(F.count("center_id") == 0, none).otherwise(F.sort_array(F.collect_list("center_id"))).alias("centers"))
        .select("person_id", "centers")
    )


def ego_expand(nodes: DataFrame, filmography: DataFrame) -> DataFrame:
    """New film nodes when every person of an ego graph is expanded, with how many of its
    people lead to each. Films already added by another person are not added twice.

    A person's films are few, so the lists of graphs go to the films and unfold there, those of a film
    that very many graphs reach over several tasks; only lists are shuffled, and each label once per list.
    """
    person, film = F.col("node_id").startswith("person_"), F.col("node_id").startswith("pfilm_")
    # Read for its people and to leave out the films it holds already.
    nodes = cut_lineage(nodes.select("center_id", "node_id").filter(person | film))
    people = nodes.filter(person).select("center_id", F.substring_index("node_id", "_", -1).try_cast("bigint").alias("person_id"))
    asked = people.groupBy("person_id").agg(F.count("*").alias("_centers"))
    films = filmography.select("person_id", "film_id", "title", year_text("release_date").alias("year")).distinct()
    label = F.concat(F.col("title"), F.lit(" ("), F.coalesce(F.col("year"), F.lit("")), F.lit(")"))
    node = F.concat(F.lit("pfilm_"), F.col("film_id").cast("string"))
    work = skew_join(films, asked, ["person_id"]).select("person_id", node.alias("node_id"), label.alias("label"), "_centers")
    rows = F.sum("_centers").over(Window.partitionBy("node_id"))
    work = cut_lineage(work.withColumn("_parts", F.ceil(rows / skew.UNFOLDED).cast("int")).drop("_centers"))

    lists = skew_join(_centers_by_person(people, asked), work, ["person_id"]).withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
    mine = F.filter("centers", lambda c: F.pmod(F.xxhash64(c), F.col("_parts")) == F.col("_part"))
    dealt = lists.select("node_id", "label", "_part", F.when(F.col("_parts") == 1, F.col("centers")).otherwise(mine).alias("centers"))
    total = work.join(asked, "person_id").agg(F.sum("_centers")).first()[0] or 0
    reached = dealt_to_unfold(dealt, ["node_id", "_part"], total).select("node_id", "label", "_part", F.explode("centers").alias("center_id"))
    added = reached.groupBy("center_id", "node_id", "_part", "label").agg(F.count("*").alias("people"))
    named = work.groupBy("node_id").agg(F.count_distinct(F.struct("label")).alias("_labels"))
    if not named.filter("_labels > 1").isEmpty():
        added = added.groupBy("center_id", "node_id", "_part").agg(F.min("label").alias("label"), F.sum("people").alias("people"))
    added = added.select("center_id", "node_id", "label", "people")
    held = nodes.filter(film)
    return added if held.isEmpty() else added.join(held, ["center_id", "node_id"], "left_anti")


# ---- paths ------------------------------------------------------------------------


def shortest_hops(credits: DataFrame, starts: DataFrame, max_films: int | None = None, stop_at: DataFrame | None = None) -> DataFrame:
    """Breadth-first search from each starting film over shared people.

    Returns (start_id, film_id, hops, via_person, from_film): the fewest film-to-film
    steps and the smallest person and film of a step that gets there, from which paths
    are read backwards. ``starts`` and ``stop_at`` hold ``film_id``; with ``stop_at`` the
    search ends once all of those films are reached; otherwise it goes on until no new film
    is found, or for ``max_films`` steps where that is given. A level visits each person and
    film once per start, so people with very many films cost their edges, never their pairs.
    """
    edges = cut_lineage(credits.select("film_id", "person_id").distinct())
    hot_films, hot_people = hot_keys(edges, "film_id"), hot_keys(edges, "person_id")
    reached = starts.select(
        F.col("film_id").alias("start_id"), "film_id", F.lit(0).alias("hops"),
        typed_null("bigint").alias("via_person"), typed_null("bigint").alias("from_film"),
    ).distinct()
    reached = frontier = cut_lineage(reached)
    known_people = None
    for hop in itertools.count(1) if max_films is None else range(1, max_films + 1):
        people = (
            skew_join(edges, frontier.select("start_id", "film_id"), ["film_id"], hot=hot_films)
            .groupBy("start_id", "person_id")
            .agg(F.min("film_id").alias("from_film"))
        )
        if known_people is not None:
            people = people.join(known_people, ["start_id", "person_id"], "left_anti")
        people = cut_lineage(people)
        steps = (
            skew_join(edges, people, ["person_id"], hot=hot_people)
            .groupBy("start_id", "film_id")
            .agg(F.min(F.struct("person_id", "from_film")).alias("s"))
            .join(reached.select("start_id", "film_id"), ["start_id", "film_id"], "left_anti")
            .select("start_id", "film_id", F.lit(hop).alias("hops"), F.col("s.person_id").alias("via_person"), F.col("s.from_film").alias("from_film"))
        )
        frontier = cut_lineage(steps)
        if frontier.isEmpty():
            break
        # Both sets are unions of stored levels.
        seen = people.select("start_id", "person_id")
        known_people = seen if known_people is None else known_people.unionByName(seen)
        reached = reached.unionByName(frontier)
        if stop_at is not None:
            open_pairs = starts.select(F.col("film_id").alias("start_id")).distinct().count() * stop_at.distinct().count()
            if reached.join(stop_at.distinct(), "film_id", "left_semi").count() == open_pairs:
                break
    return reached


def connection_paths(reached: DataFrame, pairs: DataFrame) -> DataFrame:
    """The steps of one shortest path for each (start_id, target_id) of ``pairs``.

    Returns (start_id, target_id, step, film_id, via_person), step 0 being the start, read
    backwards through what ``shortest_hops`` returned: one join per level for all pairs
    together. Pairs that aren't connected have no rows.
    """
    stored = cut_lineage(reached)
    wanted = pairs.select("start_id", "target_id", F.col("target_id").alias("film_id")).distinct()
    levels = []
    while True:
        level = cut_lineage(skew_join(wanted, stored, ["start_id", "film_id"]))
        if level.isEmpty():
            break
        levels.append(level.select("start_id", "target_id", F.col("hops").alias("step"), "film_id", "via_person"))
        wanted = level.filter("hops > 0").select("start_id", "target_id", F.col("from_film").alias("film_id"))
    if not levels:
        return level.select("start_id", "target_id", F.col("hops").alias("step"), "film_id", "via_person")
    return functools.reduce(DataFrame.unionByName, levels)


def hub_scores(credits: DataFrame, clusters: DataFrame) -> DataFrame:
    """People by how many films they join and how many clusters those films lie in."""
    placed = skew_join(credits.select("person_id", "film_id").distinct(), clusters.select("film_id", "cluster"), ["film_id"], "left")
    return placed.groupBy("person_id").agg(
        F.count("*").alias("degree"), F.countDistinct("cluster").alias("clusters_bridged")
    )


#: Votes of so many decimals travel as whole numbers.
_SCALE = 1000
#: Mark of a column of reasons in which no list was cut.
WHOLE = "whole"


def _packed(leading: Column) -> Column:
    """Films of a list as one number each, from which ``_unpacked`` gives the same ids and votes back; null where a list
    has an id or a vote that doesn't fit."""
    whole = lambda f: F.rint(f["vote_average"].cast("double") * _SCALE).try_cast("int").cast("bigint")
    fits = lambda f: f["film_id"].between(0, (1 << 31) - 1) & ((whole(f) / F.lit(float(_SCALE))) == f["vote_average"])
    return F.when(F.forall(leading, lambda f: F.coalesce(fits(f), F.lit(False))), F.transform(leading, lambda f: whole(f) * (1 << 31) + f["film_id"]))


def _unpacked(p: Column) -> Column:
    film_id = F.pmod(p, F.lit(1 << 31))
    return F.struct(film_id.alias("film_id"), (((p - film_id) / F.lit(float(1 << 31))) / F.lit(float(_SCALE))).alias("vote_average"))


def recommend(relations: DataFrame, films: DataFrame, k: int = 10, max_reasons: int = 100) -> DataFrame:
    """Best rated films that share something with each film, with the reasons.

    ``relations`` holds (film_id, reason): a person, genre or source as text. Returns
    (film_id, recommended_id, vote_average, position, shared, reasons). Each shared thing offers its
    ``k`` best other films, which contain every film it can put among a film's best ``k``. So every thing that a film
    shares with one of its best offers that one too, and what offered it are all the reasons: ``shared`` counts all,
    ``reasons`` lists the first ``max_reasons`` of them, and ``recommendation_reasons`` gives the whole list as rows.
    """
    voted = films.select("film_id", "vote_average")
    if not voted.filter("film_id is not null").groupBy("film_id").count().filter("count > 1").isEmpty():
        return _recommend_repeated(relations, voted, k, max_reasons)
    # By film alone, so that repeats go and votes come with one shuffle.
    known = relations.select("film_id", "reason").filter("film_id is not null and reason is not null").repartition("film_id").distinct()
    # A task holds its films, of which there are far fewer than relations.
    once = cut_lineage(skew_join(known, voted.withColumn("_rated", F.lit(True)).hint("shuffle_hash"), ["film_id"], "left"))
    best = [F.desc("vote_average"), F.col("film_id")]
    lists = leading_films(once.filter("_rated"), ["reason"], best, k + 1, ["film_id", "vote_average"])
    plain = F.transform("leading", lambda f: F.struct(f["film_id"].alias("film_id"), f["vote_average"].alias("vote_average")))
    lists = lists.select("reason", plain.alias("leading"))
    kinds = dict(once.dtypes)
    packable = kinds["film_id"] in ("int", "bigint") and kinds["vote_average"] == "double"
    lists = lists.withColumn("packed", _packed(F.col("leading")) if packable else F.lit(None).cast("array<bigint>"))
    lists = lists.withColumn("leading", F.when(F.col("packed").isNull(), F.col("leading")))
    # What is offered to a film meets as lists, and is one row each only where it has met.
    others = lambda c, film_id: F.slice(F.filter(c, lambda f: film_id(f) != F.col("film_id")), 1, k)
    met = skew_join(once.select("film_id", "reason"), lists, ["reason"]).select(
        "film_id", "reason",
        others("packed", lambda p: F.pmod(p, F.lit(1 << 31))).alias("packed"), others("leading", lambda f: f["film_id"]).alias("leading"),
    )
    met = met.filter((F.size("packed") > 0) | (F.size("leading") > 0))
    unpacked = F.transform("packed", _unpacked).cast(lists.schema["leading"].dataType)
    offered = (
        dealt_to_unfold(met, "film_id", once.count() * k)
        .select("film_id", "reason", F.explode(F.coalesce("leading", unpacked)).alias("f"))
        .select("film_id", "reason", F.col("f.film_id").alias("recommended_id"), F.col("f.vote_average").alias("vote_average"))
    )
    # The same offer of several things is one place.
    place = F.dense_rank().over(Window.partitionBy("film_id").orderBy(F.desc("vote_average"), "recommended_id"))
    chosen = offered.withColumn("position", place).filter(F.col("position") <= k)
    cut = not once.groupBy("film_id").count().filter(F.col("count") > max_reasons).isEmpty()
    found = _listed(chosen, ["film_id", "recommended_id", "vote_average", "position"], max_reasons)
    return found if cut else found.withColumn("reasons", F.col("reasons").alias("reasons", metadata={WHOLE: True}))


def _listed(reasons: DataFrame, keys: list[str], max_reasons: int) -> DataFrame:
    """How many reasons each pair has, and the first of them."""
    numbered = reasons.withColumn("_nth", F.row_number().over(Window.partitionBy("film_id", "recommended_id").orderBy("reason")))
    first = F.collect_list(F.when(F.col("_nth") <= max_reasons, F.col("reason")))
    return numbered.groupBy(*keys).agg(F.count("*").alias("shared"), F.sort_array(first).alias("reasons"))


def _recommend_repeated(relations: DataFrame, films: DataFrame, k: int, max_reasons: int) -> DataFrame:
    """``recommend`` where films are listed more than once: a list then holds fewer films than places, so the reasons of
    the chosen films are looked up."""
    once = cut_lineage(relations.select("film_id", "reason").distinct())
    rated = skew_join(once, films, ["film_id"])
    best = [F.desc("vote_average"), F.col("film_id")]
    lists = leading_films(rated, ["reason"], best, k + 1, ["film_id", "vote_average"])
    lists = lists.select("reason", F.col("leading.film_id").alias("ids"), F.col("leading.vote_average").alias("votes"))
    # What is offered to a film meets as lists, and is one row each only where it has met.
    met = skew_join(once.filter("film_id is not null"), lists, ["reason"]).select("film_id", "ids", "votes")
    offered = (
        dealt_to_unfold(met, "film_id", once.count() * (k + 1))
        .select("film_id", F.explode(F.arrays_zip("ids", "votes")).alias("f"))
        .select("film_id", F.col("f.ids").alias("recommended_id"), F.col("f.votes").alias("vote_average"))
        .filter("recommended_id != film_id")
    )
    # The same offer of several things is one place; it is dropped when the cut has left few rows.
    place = F.dense_rank().over(Window.partitionBy("film_id").orderBy(F.desc("vote_average"), "recommended_id"))
    chosen = cut_lineage(offered.withColumn("position", place).filter(F.col("position") <= k).distinct())
    pair = ["film_id", "recommended_id"]
    listed = _listed(recommendation_reasons(once, chosen), pair, max_reasons)
    return chosen.join(listed, pair).select(*chosen.columns, "shared", "reasons")


def _marks(reason: str) -> Column:
    """One of 64 bits for a reason."""
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(F.xxhash64(reason), F.lit(64)).cast("int"))


def recommendation_reasons(relations: DataFrame, pairs: DataFrame) -> DataFrame:
    """``film_id, recommended_id, reason``: everything the films of each pair share, one row each.

    Pairs as ``recommend`` returns them bring their reasons along, so only those whose list was cut are looked up.
    """
    pair = ["film_id", "recommended_id"]
    if not {"shared", "reasons"} <= set(pairs.columns):
        return _shared_reasons(relations, pairs)
    whole = pairs.schema["reasons"].metadata.get(WHOLE, False)
    # Read for both kinds of lists.
    pairs = pairs if whole else cut_lineage(pairs.select(*pair, "shared", "reasons"))
    listed = F.size("reasons") == F.col("shared")
    known = pairs.filter(F.lit(True) if whole else listed).select(*pair, F.explode(F.array_distinct("reasons")).alias("reason"))
    if whole or (rest := pairs.filter(~listed)).isEmpty():
        return known
    return known.unionByName(_shared_reasons(cut_lineage(relations.select("film_id", "reason").distinct()), rest))


def _shared_reasons(relations: DataFrame, pairs: DataFrame) -> DataFrame:
    """The reasons of any pairs, looked up."""
    once = relations.select("film_id", "reason").distinct()
    theirs = once.withColumnRenamed("film_id", "recommended_id")
    # The bits of all reasons of the recommended film leave out most of what the pair can't share before rows meet.
    bits = theirs.groupBy("recommended_id").agg(F.bit_or(_marks("reason")).alias("_bits"))
    marked = skew_join(pairs.select("film_id", "recommended_id"), bits, ["recommended_id"])
    likely = skew_join(once, marked, ["film_id"]).filter(F.col("_bits").bitwiseAND(_marks("reason")) != 0).drop("_bits")
    return skew_join(likely, theirs, ["recommended_id", "reason"], "left_semi")
