"""Nested documents to graph nodes and edges.

Every mapper takes a DataFrame of documents (one row each) and returns a
``Graph``: nodes (id, label, name, props) and edges (src, dst, type).  Documents
are exploded and joined as tables; nothing is gathered per document.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from finloom.functions import ids, text
from finloom.functions.finance import magnitude
from finloom.operators import chains, dedup, graph, similarity
from finloom.plans.catalog import query
from finloom.session import table
from finloom.storage import materialise_dealt

# Source types and what they are normalised to; others stay.
SOURCE_TYPES = {
    "tower_company_analysis": "analysis",
    "company_analysis": "analysis",
    "digital_services_analysis": "analysis",
    "regulatory_analysis": "analysis",
    "political_analysis": "analysis",
    "macro_data": "data",
    "spectrum_data": "data",
    "web-research": "web",
    "annual_report": "company_filing",
    "regulatory_filing": "company_filing",
    "research": "report",
    "official": "report",
    "original": "report",
}
AUTHORITIES = ("official", "analyst", "media", "blog", "social", "academic")


@dataclass
class Graph:
    """Nodes and edges, and the rows that they are the distinct ones of: what
    aggregates rows anyway needn't shuffle them for that before.

    Edge rows may also bring the names that their own rows give both ends
    (src_name, dst_name), so that names needn't be joined to all edges; whether dst
    is a node of these rows (known; src is one); and whether no other row is of
    the same edge (once).
    """

    node_rows: DataFrame
    edge_rows: DataFrame

    @property
    def nodes(self) -> DataFrame:
        return self.node_rows.distinct()

    @property
    def edges(self) -> DataFrame:
        return self.edge_rows.select("src", "dst", "type").distinct()

    def __add__(self, other: Graph) -> Graph:
        bare = [g.edge_rows.select("src", "dst", "type") for g in (self, other)]
        return Graph(self.node_rows.unionByName(other.node_rows), bare[0].unionByName(bare[1]))


def _nodes(df: DataFrame, label: str, id_: Column, name: Column, **props: Column) -> DataFrame:
    pairs = [x for k, v in props.items() for x in (F.lit(k), v.cast("string"))]
    given = F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull()) if pairs else F.create_map().cast("map<string,string>")
    return df.select(id_.alias("id"), F.lit(label).alias("label"), name.alias("name"), F.to_json(given).alias("props")).where(F.col("id").isNotNull())


def _edges(df: DataFrame, src: Column, dst: Column, kind: str) -> DataFrame:
    found = df.select(src.alias("src"), dst.alias("dst"), F.lit(kind).alias("type"))
    return found.where(F.col("src").isNotNull() & F.col("dst").isNotNull())


def _named_edges(df: DataFrame, src: Column, src_name: Column, dst: Column, dst_name: Column, kind: str, known: Column | None = None) -> DataFrame:
    """Edges with the names of their ends."""
    known = F.lit(True) if known is None else known
    found = df.select(
        src.alias("src"), dst.alias("dst"), F.lit(kind).alias("type"), src_name.alias("src_name"), dst_name.alias("dst_name"), known.alias("known"), F.lit(False).alias("once")
    )
    return found.where(F.col("src").isNotNull() & F.col("dst").isNotNull())


def union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def no_edges(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "src string, dst string, type string")


def source_type(raw: Column) -> Column:
    out = raw
    for name, normal in SOURCE_TYPES.items():
        out = F.when(raw == name, normal).otherwise(out)
    return out


def given(column: Column) -> Column:
    return F.coalesce(F.trim(column) != "", F.lit(False))


def map_news(batches: DataFrame) -> Graph:
    """articles (url, title, summary, published) to sources and, where a summary
    isn't blank, claims made by them."""
    a = batches.select(F.inline("articles")).where(given(F.col("url")))
    claims = a.where(given(F.col("summary")))
    of_claim = ids.content_id(F.col("summary"))
    return Graph(
        union([
            _nodes(a, "Source", ids.source_id(F.col("url")), F.col("title"), url=F.col("url"), published=F.col("published")),
            _nodes(claims, "Claim", of_claim, F.col("summary")),
        ]),
        _edges(claims, ids.source_id(F.col("url")), of_claim, "MAKES_CLAIM"),
    )


def map_companies(batches: DataFrame) -> Graph:
    """companies (company_name, ticker, url, title, published) to entities and, with a URL, sources."""
    c = batches.select(F.inline("companies")).where(given(F.col("company_name")))
    entity = ids.keyed_id("entity", F.col("company_name"), F.lit("company"))
    sourced = c.where(given(F.col("url")))
    return Graph(
        union([
            _nodes(c, "Entity", entity, F.col("company_name"), ticker=F.col("ticker")),
            _nodes(sourced, "Source", ids.source_id(F.col("url")), F.col("title"), url=F.col("url"), published=F.col("published")),
        ]),
        _edges(sourced, ids.source_id(F.col("url")), entity, "ABOUT"),
    )


def map_market_report(reports: DataFrame) -> Graph:
    """sections (title, content, sources) to sources, the first of every URL, and claims."""
    s = reports.select(F.posexplode("sections").alias("at", "s"))
    sources = s.select("at", F.posexplode("s.sources").alias("place", "x")).select("at", "place", "x.url", "x.title", "x.published").where(given(F.col("url")))
    first = dedup.first_wins(sources, ["url"], ["at", "place"])
    claims = s.where(given(F.col("s.content"))).select(F.col("s.content").alias("content"), F.col("s.title").alias("title"))
    edges = s.where(given(F.col("s.content"))).select(F.explode("s.sources").alias("x"), F.col("s.content").alias("content"))
    return Graph(
        union([
            _nodes(first, "Source", ids.source_id(F.col("url")), F.col("title"), url=F.col("url"), published=F.col("published")),
            _nodes(claims, "Claim", ids.content_id(F.col("content")), F.col("content"), section=F.col("title")),
        ]),
        _edges(edges.where(given(F.col("x.url"))), ids.source_id(F.col("x.url")), ids.content_id(F.col("content")), "MAKES_CLAIM"),
    )


def map_themes(batches: DataFrame, category: str = "asset-management") -> Graph:
    """themes (key to name_ja and articles) to topics and tagged sources."""
    t = batches.select(F.explode("themes").alias("key", "t"))
    topic = ids.keyed_id("topic", F.col("t.name_ja"), F.lit(category))
    a = t.select("t", F.explode("t.articles").alias("a")).where(given(F.col("a.url")))
    return Graph(
        union([
            _nodes(t, "Topic", topic, F.col("t.name_ja"), key=F.col("key"), category=F.lit(category)),
            _nodes(a, "Source", ids.source_id(F.col("a.url")), F.col("a.title"), url=F.col("a.url"), published=F.col("a.published")),
        ]),
        _edges(a, ids.source_id(F.col("a.url")), topic, "TAGGED"),
    )


def map_forum(batches: DataFrame) -> Graph:
    """topics (name, url, title, score) to topics and sources."""
    t = batches.select(F.inline("topics")).where(given(F.col("name")))
    topic = ids.keyed_id("topic", F.col("name"), F.lit("reddit"))
    sourced = t.where(given(F.col("url")))
    return Graph(
        union([
            _nodes(t, "Topic", topic, F.col("name"), score=F.col("score")),
            _nodes(sourced, "Source", ids.source_id(F.col("url")), F.col("title"), url=F.col("url")),
        ]),
        _edges(sourced, ids.source_id(F.col("url")), topic, "TAGGED"),
    )


def map_extraction(documents: DataFrame, parts: int | None = None) -> Graph:
    """Extraction documents to chunks, entities, facts, claims, data points, periods,
    stances, authors and questions.

    documents: source_hash, publisher and chunks (chunk_index, content, entities,
    facts, claims, financial_datapoints, stances, causal_links, questions).
    Names that no entity of the document bears are dropped from edges.

    Chunks are written once, dealt by source_hash into ``parts`` (as many as shuffles
    have): what is looked up or told apart in a document, over windows and groups
    that begin with it, isn't shuffled.
    """
    source = F.col("source_hash")
    parts = parts or int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    c = materialise_dealt(documents.select("source_hash", "publisher", F.explode("chunks").alias("c")), "chunks", "source_hash", parts)
    chunk = F.concat_ws("_chunk_", source, F.col("c.chunk_index").cast("string"))
    title = F.col("c.section_title")
    found = lambda field: c.where(F.size(f"c.{field}") > 0).select("source_hash", "publisher", chunk.alias("chunk"), title.alias("title"), F.posexplode(f"c.{field}").alias("place", "x"))

    e = found("entities").where(given(F.col("x.name")))
    entity = ids.keyed_id("entity", F.col("x.name"), F.lower("x.entity_type"))
    facts = found("facts").where(given(F.col("x.content")))
    fact = ids.content_id(F.col("x.content"), "fact")
    claims = found("claims").where(given(F.col("x.content")))
    claim = ids.content_id(F.col("x.content"))
    points = found("financial_datapoints").where(given(F.col("x.metric_name")))
    point = ids.datapoint_id(source, F.col("x.metric_name"), F.coalesce("x.period_label", F.lit("")))
    stances = found("stances").where(given(F.col("x.author_name")) & given(F.col("x.entity_name")))
    stance = ids.keyed_id("stance", F.col("x.author_name"), F.col("x.entity_name"), F.coalesce("x.as_of_date", F.lit("")))
    author = ids.keyed_id("author", F.col("x.author_name"), F.col("x.author_type"))
    questions = found("questions").where(given(F.col("x.content")))
    question = ids.content_id(F.col("x.content"), "question")
    publisher, text_, metric, rating = F.col("publisher"), F.col("x.content"), F.col("x.metric_name"), F.col("x.rating")

    def mentions(rows: DataFrame, kind: str, own: Column, name: Column, about: Column, label: Column | None = None) -> DataFrame:
        label = F.lit(None).cast("string") if label is None else label
        return rows.select("source_hash", about.alias("about"), F.lit(kind).alias("type"), own.alias("own"), name.alias("name"), label.alias("label"))

    def met(rows: list[DataFrame]) -> DataFrame:
        """Mentions with the last entity of their document that bears the name, if any."""
        last = F.struct("chunk", "place", entity.alias("entity"), F.col("x.ticker").alias("ticker")).alias("last")
        known = e.where(source.isNotNull()).select("source_hash", F.col("x.name").alias("about"), last)
        every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [*rows, known])
        return every.withColumn("last", F.max("last").over(Window.partitionBy("source_hash", "about"))).where(F.col("type").isNotNull())

    about = F.explode("x.about_entities")
    of_period = mentions(points, "FOR_PERIOD", point, metric, F.get("x.about_entities", F.lit(0)), F.col("x.period_label"))
    period = F.when(given(F.col("label")), F.concat_ws("_", F.nullif(F.col("last.ticker"), F.lit("")), F.col("label")))
    to_period = F.col("type") == "FOR_PERIOD"
    about_edges = met([
        mentions(facts, "RELATES_TO", fact, text_, about),
        mentions(claims, "ABOUT", claim, text_, about),
        mentions(points, "RELATES_TO", point, metric, about),
        mentions(stances, "ON_ENTITY", stance, rating, F.col("x.entity_name")),
        mentions(questions, "ASKS_ABOUT", question, text_, about),
        of_period,
    ]).select(
        F.col("own").alias("src"), F.when(to_period, period).otherwise(F.col("last.entity")).alias("dst"), "type",
        F.col("name").alias("src_name"), F.when(to_period, F.col("label")).otherwise(F.col("about")).alias("dst_name"), F.lit(True).alias("known"), F.lit(False).alias("once"),
    ).where(F.col("src").isNotNull() & F.col("dst").isNotNull())

    of = lambda rows, kind, content, *more: rows.select("source_hash", F.lit(kind).alias("kind"), content.alias("content"), *more)
    asked = questions.select("source_hash", F.explode("x.motivated_by_contents").alias("content"), text_.alias("own"))
    answers = union([of(facts, "fact", text_), of(claims, "claim", text_)]).where(source.isNotNull())
    best = F.max("kind").over(Window.partitionBy("source_hash", "content"))  # a fact before a claim
    motivated = answers.unionByName(asked, allowMissingColumns=True).withColumn("kind", best).where(F.col("own").isNotNull() & F.col("kind").isNotNull())
    motivated = motivated.groupBy("own", "content").agg(F.max("kind").alias("kind"))
    motive = F.when(F.col("kind") == "fact", ids.content_id(F.col("content"), "fact")).otherwise(ids.content_id(F.col("content")))

    based = stances.select("source_hash", F.explode("x.based_on_claims").alias("content"), stance.alias("own"), rating.alias("name"))
    based = of(claims, "claim", text_).unionByName(based, allowMissingColumns=True)
    based = based.withColumn("kind", F.max("kind").over(Window.partitionBy("source_hash", "content"))).where(F.col("own").isNotNull())

    contents = union([of(facts, "fact", text_, fact.alias("id")), of(claims, "claim", text_, claim.alias("id")), of(points, "datapoint", metric, point.alias("id"))])
    contents = contents.groupBy("source_hash", "kind", "content").agg(F.collect_set("id").alias("ids"))

    def ends(links: DataFrame, end: str) -> DataFrame:
        """Links with an id of their end, a row for each; those with an unknown end are dropped."""
        every = links.withColumns({"kind": F.col(f"x.{end}_type"), "content": F.col(f"x.{end}_content")}).unionByName(contents, allowMissingColumns=True)
        of_end = F.max("ids").over(Window.partitionBy("source_hash", "kind", "content"))
        return every.withColumn("ids", of_end).where(F.col("x").isNotNull()).withColumn(end, F.explode("ids")).drop("kind", "content", "ids")

    causal = ends(ends(found("causal_links").select("source_hash", "x"), "from"), "to")

    nodes = [
        _nodes(documents, "Source", source, publisher),
        _nodes(c, "Chunk", chunk, title),
        _nodes(e, "Entity", entity, F.col("x.name"), entity_type=F.lower("x.entity_type"), ticker=F.col("x.ticker")),
        _nodes(facts, "Fact", fact, text_, fact_type=F.col("x.fact_type"), as_of_date=F.col("x.as_of_date")),
        _nodes(claims, "Claim", claim, text_, claim_type=F.col("x.claim_type"), sentiment=F.col("x.sentiment")),
        _nodes(points, "FinancialDataPoint", point, metric, value=F.col("x.value"), period=F.col("x.period_label")),
        _nodes(met([of_period]), "FiscalPeriod", period, F.col("label")),
        _nodes(stances, "Stance", stance, rating, as_of_date=F.col("x.as_of_date")),
        _nodes(stances, "Author", author, F.col("x.author_name"), author_type=F.col("x.author_type")),
        _nodes(questions, "Question", question, text_, priority=F.col("x.priority")),
    ]
    held = union([
        rows.select("source_hash", id_.alias("dst"), F.lit(kind).alias("type"), "publisher", name.alias("name"))
        for kind, rows, id_, name in (
            ("CONTAINS_CHUNK", c, chunk, title), ("STATES_FACT", facts, fact, text_), ("MAKES_CLAIM", claims, claim, text_), ("HAS_DATAPOINT", points, point, metric), ("RAISES_QUESTION", questions, question, text_),
        )
    ]).where(source.isNotNull() & F.col("dst").isNotNull()).groupBy("source_hash", "dst", "type").agg(F.min("publisher").alias("src_name"), F.min("name").alias("dst_name"))
    edges = [
        held.select(source.alias("src"), "dst", "type", "src_name", "dst_name", F.lit(True).alias("known"), F.lit(True).alias("once")),
        _named_edges(facts, fact, text_, F.col("chunk"), F.col("title"), "EXTRACTED_FROM"),
        _named_edges(claims, claim, text_, F.col("chunk"), F.col("title"), "EXTRACTED_FROM"),
        _named_edges(stances, author, F.col("x.author_name"), stance, rating, "HOLDS_STANCE"),
        about_edges,
        _named_edges(based, F.col("own"), F.col("name"), ids.content_id(F.col("content")), F.col("content"), "BASED_ON", F.col("kind").isNotNull()),
        _named_edges(motivated, ids.content_id(F.col("own"), "question"), F.col("own"), motive, F.col("content"), "MOTIVATED_BY"),
        _named_edges(causal, F.col("from"), F.col("x.from_content"), F.col("to"), F.col("x.to_content"), "CAUSES"),
    ]
    return Graph(union(nodes), union(edges))


def stance_chain(stances: DataFrame) -> DataFrame:
    """SUPERSEDES edges of stances (id, author, entity, as_of_date): newer to older;
    a bad date is the oldest."""
    day = F.coalesce(F.expr("try_cast(as_of_date AS date)"), F.to_date(F.lit("0001-01-01")))
    linked = chains.chain(stances.withColumn("day", day), ["author", "entity"], ["day", "id"], ["id"])
    return linked.select(F.col("id").alias("src"), F.col("prev_id").alias("dst"), F.lit("SUPERSEDES").alias("type"))


def map_papers(papers: DataFrame, existing: DataFrame, most_authors: int = 50) -> Graph:
    """Papers (pos, arxiv_id, title, authors of name and organization, references
    of arxiv_id) to sources and authors, who wrote what, citations of what is
    known, and co-authors; a paper of over ``most_authors`` makes no pairs."""
    source = lambda c: ids.source_id(F.concat(F.lit("https://arxiv.org/abs/"), c))
    a = papers.select("arxiv_id", F.explode("authors").alias("x")).where(given(F.col("x.name")))
    author = ids.keyed_id("author", F.col("x.name"), F.lit("academic"))
    listed = papers.select("pos", F.col("arxiv_id").alias("id"), F.transform("references", lambda r: r["arxiv_id"]).alias("cites"))
    cites = similarity.citations_in_order(listed, existing)
    pairs = graph.shared_members(a.select(author.alias("item"), F.col("arxiv_id").alias("group")), 1, most_authors)
    return Graph(
        union([
            _nodes(papers, "Source", source(F.col("arxiv_id")), F.col("title"), arxiv_id=F.col("arxiv_id")),
            _nodes(a, "Author", author, F.col("x.name"), organization=F.col("x.organization")),
        ]),
        union([
            _edges(a, source(F.col("arxiv_id")), author, "AUTHORED_BY"),
            _edges(cites, source(F.col("src")), source(F.col("dst")), "CITES"),
            _edges(pairs, F.col("a"), F.col("b"), "COAUTHORED_WITH"),
        ]),
    )


def map_web_research(documents: DataFrame) -> Graph:
    """sources (url, title, authority_level), topics (name, category) and facts
    (content, source_url): every source has every topic of its document; a fact
    of an unknown source is dropped; an unknown authority stops the query."""
    s = documents.select("session_id", F.inline("sources")).where(given(F.col("url")))
    checked = F.when(F.col("authority_level").isin(*AUTHORITIES), F.col("authority_level")).otherwise(
        F.raise_error(F.concat(F.lit("unknown authority: "), F.coalesce("authority_level", F.lit("null"))))
    )
    t = documents.select("session_id", F.inline("topics"))
    topic = ids.keyed_id("topic", F.col("name"), F.col("category"))
    facts = documents.select("session_id", F.inline("facts")).where(given(F.col("content")))
    known = facts.join(s.select("session_id", F.col("url").alias("source_url")).distinct(), ["session_id", "source_url"])
    fact = ids.content_id(F.col("content"), "fact")
    tagged = lambda rows, own: _edges(rows.select("session_id", own.alias("own")).join(t, "session_id"), F.col("own"), topic, "TAGGED")
    return Graph(
        union([
            _nodes(s, "Source", ids.source_id(F.col("url")), F.col("title"), url=F.col("url"), authority=checked),
            _nodes(t, "Topic", topic, F.col("name"), category=F.col("category")),
            _nodes(known, "Fact", fact, F.col("content")),
        ]),
        union([
            tagged(s, ids.source_id(F.col("url"))),
            tagged(known, fact),
            _edges(known, ids.source_id(F.col("source_url")), fact, "STATES_FACT"),
        ]),
    )


def map_topic_discovery(sessions: DataFrame) -> Graph:
    """suggestions (rank, topic, category, rationale, total, key_points,
    suggested_symbols) to recommendations, topics and symbols; trends (query,
    key_findings) to facts.  Ids are names within the session."""
    s = sessions.select("session_id", F.inline("suggestions"))
    claim = F.concat(F.lit("ts:"), F.col("session_id"), F.lit(":rank"), F.coalesce("rank", F.lit(0)).cast("string"))
    topic = F.when(given(F.col("category")), F.concat(F.lit("content:"), F.col("category")))
    said = F.concat_ws(": ", "topic", F.when(given(F.col("rationale")), F.col("rationale")))
    symbols = s.select(claim.alias("claim"), F.explode("suggested_symbols").alias("symbol"))
    symbol = F.concat(F.lit("symbol:"), F.col("symbol"))
    trends = sessions.select("session_id", F.posexplode("trends").alias("i", "t"))
    findings = trends.select("session_id", "i", F.col("t.query").alias("query"), F.posexplode("t.key_findings").alias("j", "finding"))
    fact = F.concat_ws(":", F.lit("trend"), "session_id", F.col("i").cast("string"), F.col("j").cast("string"))
    return Graph(
        union([
            _nodes(sessions, "Source", F.col("session_id"), F.col("session_id"), suggestions=F.size("suggestions")),
            _nodes(s, "Topic", topic, F.col("category")),
            _nodes(s, "Claim", claim, said, magnitude=magnitude(F.coalesce("total", F.lit(0))), key_points=F.to_json(F.coalesce("key_points", F.array().cast("array<string>")))),
            _nodes(symbols, "Entity", symbol, F.col("symbol"), entity_type=F.when(F.col("symbol").startswith("^"), "index").otherwise("stock")),
            _nodes(findings, "Fact", fact, F.col("finding"), query=F.col("query")),
        ]),
        union([
            _edges(s, F.col("session_id"), claim, "MAKES_CLAIM"),
            _edges(s, claim, topic, "TAGGED"),
            _edges(symbols, F.col("claim"), symbol, "ABOUT"),
            _edges(findings, F.col("session_id"), fact, "STATES_FACT"),
        ]),
    )


def map_wealth_blogs(batches: DataFrame, backfill: bool) -> Graph:
    """themes (key to name_en, keywords_en and articles of url, title, domain,
    summary) to topics and sources, tagged where a keyword is in the title.  A
    backfill adds the domains; otherwise summaries become claims."""
    t = batches.select(F.explode("themes").alias("key", "t"))
    topic = ids.keyed_id("topic", F.col("t.name_en"), F.lit("wealth-management"))
    a = t.select("t", F.explode("t.articles").alias("a")).where(given(F.col("a.url")))
    source = ids.source_id(F.col("a.url"))
    low = F.lower(F.coalesce("a.title", F.lit("")))
    tagged = a.where(F.exists("t.keywords_en", lambda k: F.contains(low, F.lower(k))))
    nodes = [
        _nodes(t, "Topic", topic, F.col("t.name_en"), key=F.col("key")),
        _nodes(a, "Source", source, F.col("a.title"), url=F.col("a.url"), source_type=F.lit("blog")),
    ]
    edges = [_edges(tagged, source, topic, "TAGGED")]
    if backfill:
        named = a.where(given(F.col("a.domain")))
        nodes.append(_nodes(named, "Entity", ids.keyed_id("entity", F.col("a.domain"), F.lit("domain")), F.col("a.domain"), entity_type=F.lit("domain")))
    else:
        told = a.where(given(F.col("a.summary")))
        claim = ids.content_id(F.col("a.summary"))
        nodes.append(_nodes(told, "Claim", claim, F.col("a.summary")))
        edges.append(_edges(told, source, claim, "MAKES_CLAIM"))
    return Graph(union(nodes), union(edges))


def map_creator(documents: DataFrame, entity_types: tuple[str, ...]) -> Graph:
    """contents (kind, content, topic, about_entities of name and entity_type) of
    a genre to facts, tips and stories with their topics and entities;
    entity_relations (from_entity, to_entity as ``name::type``) to edges.
    Entities of other types, and relations with an end that no content
    mentions, are dropped.  Ids of contents and topics have 32 digits: eight, as
    the reference has, are the same for two of some hundred thousand texts."""
    c = documents.select("genre_id", F.inline("contents")).where(given(F.col("content")))
    own = ids.content_id(F.col("content"))
    topic = F.when(given(F.col("topic")), ids.content_id(F.concat_ws(":", F.lit("topic"), text.slug(F.col("topic")), "genre_id")))
    e = c.select("genre_id", own.alias("own"), F.inline("about_entities")).withColumn("entity_type", F.lower(F.trim("entity_type")))
    e = e.withColumn("name", F.trim("name")).where(given(F.col("name")) & F.col("entity_type").isin(*entity_types))
    entity = ids.keyed_id("entity", F.col("name"), F.col("entity_type"))
    known = e.select(F.concat_ws("::", "name", "entity_type").alias("key"), entity.alias("id")).distinct()
    links = documents.select(F.inline("entity_relations")).select(F.col("from_entity").alias("from_key"), F.col("to_entity").alias("to_key"))
    return Graph(
        union([
            _nodes(c, "Content", own, F.col("content"), kind=F.col("kind")),
            _nodes(c, "Topic", topic, F.col("topic"), genre=F.col("genre_id")),
            _nodes(e, "Entity", entity, F.col("name"), entity_type=F.col("entity_type")),
        ]),
        union([
            _edges(c, own, topic, "ABOUT"),
            _edges(e, F.col("own"), entity, "MENTIONS"),
            similarity.resolve_endpoints(links, known).withColumn("type", F.lit("RELATES_TO")),
        ]),
    )


# What concepts may be to each other.
CONCEPT_RELATIONS = ("ENABLES", "REQUIRES", "COMPETES_WITH")


def map_creator_concepts(documents: DataFrame, entity_types: tuple[str, ...], layers: dict[str, str]) -> Graph:
    """The second form of creator documents: sources (url, title) and their
    domains, entities (name, entity_type), concepts (name, category), contents
    (kind, content, source_url, about_concepts, about_entities), serves_as
    (entity_name, concept_name) and concept_relations (from_concept, to_concept,
    rel_type), of a genre (genre_id); doc names the document.

    Names join within their document; a relation with an unknown end or of an
    unknown kind, and a category without a layer, are dropped.
    """
    key = "doc"
    d = documents
    s = d.select(key, F.inline("sources")).withColumn("url", F.trim("url")).where(given(F.col("url")))
    source = ids.source_id(F.col("url"))
    domain = F.regexp_replace(F.lower(F.regexp_extract("url", r"^[A-Za-z]+://([^/?#]*)", 1)), r"^www\.", "")
    e = d.select(key, F.inline("entities")).select(key, F.trim("name").alias("name"), F.lower(F.trim("entity_type")).alias("entity_type"))
    e = e.where(given(F.col("name")) & F.col("entity_type").isin(*entity_types)).withColumn("entity", ids.keyed_id("entity", F.col("name"), F.col("entity_type")))
    c = d.select(key, F.inline("concepts")).select(key, F.trim("name").alias("name"), F.trim("category").alias("category")).where(given(F.col("name")))
    c = c.withColumn("concept", ids.keyed_id("concept", F.col("name")))
    layer = F.lit(None).cast("string")
    for name, value in layers.items():
        layer = F.when(F.col("category") == name, value).otherwise(layer)
    x = d.select(key, "genre_id", F.inline("contents")).withColumn("content", F.trim("content")).where(given(F.col("content")))
    x = x.withColumn("own", ids.content_id(F.concat_ws(":", F.lower("kind"), "content")))
    # A name that an entity list repeats stands for its last type in order.
    by_name = e.groupBy(key, F.col("name").alias("e_name")).agg(F.max_by("entity", "entity_type").alias("entity"))
    concepts = c.select(key, F.col("name").alias("c_name"), "concept").distinct()
    about = x.select(key, "own", F.explode("about_concepts").alias("c_name")).join(concepts, [key, "c_name"])
    mentions = x.select(key, "own", F.explode("about_entities").alias("e_name")).join(by_name, [key, "e_name"])
    cited = x.join(s.select(key, F.col("url").alias("source_url")).distinct(), [key, "source_url"])
    serves = d.select(key, F.inline("serves_as")).select(key, F.col("entity_name").alias("e_name"), F.col("concept_name").alias("c_name")).join(by_name, [key, "e_name"]).join(concepts, [key, "c_name"])
    ends = lambda end: concepts.select(key, F.col("c_name").alias(f"{end}_concept"), F.col("concept").alias(f"{end}_id"))
    r = d.select(key, F.inline("concept_relations")).where(F.col("rel_type").isin(*CONCEPT_RELATIONS))
    r = r.join(ends("from"), [key, "from_concept"]).join(ends("to"), [key, "to_concept"])
    typed = r.select(F.col("from_id").alias("src"), F.col("to_id").alias("dst"), F.col("rel_type").alias("type"))
    return Graph(
        union([
            _nodes(s, "Source", source, F.col("title"), url=F.col("url")),
            _nodes(s, "Domain", F.nullif(domain, F.lit("")), domain),
            _nodes(e, "Entity", F.col("entity"), F.col("name"), entity_type=F.col("entity_type")),
            _nodes(c, "Concept", F.col("concept"), F.col("name")),
            _nodes(c.where(layer.isNotNull()), "ConceptCategory", F.col("category"), F.col("category"), layer=layer),
            _nodes(x, "Content", F.col("own"), F.col("content"), kind=F.lower("kind")),
            _nodes(d, "Genre", F.col("genre_id"), F.col("genre_id")),
        ]),
        union([
            _edges(s, source, F.nullif(domain, F.lit("")), "FROM_DOMAIN"),
            _edges(c, F.col("concept"), F.nullif("category", F.lit("")), "IS_A"),
            _edges(about, F.col("own"), F.col("concept"), "ABOUT"),
            _edges(mentions, F.col("own"), F.col("entity"), "MENTIONS"),
            _edges(cited, F.col("own"), ids.source_id(F.col("source_url")), "FROM_SOURCE"),
            _edges(x, F.col("own"), F.col("genre_id"), "IN_GENRE"),
            _edges(serves, F.col("entity"), F.col("concept"), "SERVES_AS"),
            typed,
        ]),
    )


#: Commands and the mappers that take their documents.
MAPPERS = {
    "finance-news": map_news,
    "ai-research": map_companies,
    "market-report": map_market_report,
    "asset-management": map_themes,
    "reddit-topics": map_forum,
    "pdf-extraction": map_extraction,
    "academic": map_papers,
    "web-research": map_web_research,
    "topic-discovery": map_topic_discovery,
    "wealth-scrape": map_wealth_blogs,
    "creator-enrichment": map_creator,
    "creator-enrichment-v2": map_creator_concepts,
}


def merge_nodes(existing: DataFrame, new: DataFrame) -> DataFrame:
    """New nodes replace those of their id; a null keeps the old value."""
    return dedup.upsert_keep(existing, new, "id")


@query("""
WITH h AS (SELECT page_id, url, left(sha256('page:' || url), 32) AS claim, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode(url)) AS d FROM pages),
n AS (SELECT 'Source' AS label, concat(substr(d, 1, 8), '-', substr(d, 9, 4), '-5', substr(d, 14, 3), '-', substr('89ab', (CAST('0x' || substr(d, 17, 1) AS INTEGER) % 4) + 1, 1), substr(d, 18, 3), '-', substr(d, 21, 12)) AS id FROM h
  UNION ALL SELECT 'Claim', left(sha256('summary of ' || url), 32) FROM h)
SELECT DISTINCT label, id FROM n""")
def map_news_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of pages taken as articles, each with a summary that names its URL."""
    pages = table(spark, sf_dir, "pages").select(
        F.array(F.struct("url", F.lit(None).cast("string").alias("title"), F.concat(F.lit("summary of "), "url").alias("summary"), F.lit(None).cast("string").alias("published"))).alias("articles")
    )
    return map_news(pages).nodes.select("label", "id")


