"""Document and retrieval jobs. Documents play the catalogue items, conversations the
reviews, unit vectors the embeddings of items and queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.catalog.common import Catalogue, r
from ledgerline.functions.text import json_names, strip_reasoning
from ledgerline.operators import documents as docs
from ledgerline.operators import retrieval as rt
from ledgerline.operators.inverted_file import approximate_nearest
from ledgerline.params import RetrievalParams
from ledgerline.session import materialise
from ledgerline.sources import files, roles

catalogue = Catalogue()
P = RetrievalParams()
# Fixed value: the instruction used when no prompt file is given.
SYSTEM_PROMPT = "You are a knowledgeable gaming expert. Recommend games based on the retrieved context."

# Column name to (Spark SQL, DuckDB SQL); one entry where both read the same.
_TAG_NAMES = ("lang", "source", "'q' || cast(quality as varchar(20))", "'t' || cast(toxic as varchar(20))", "'n' || cast(n_chars as varchar(20))", "'d' || cast(doc_id as varchar(20))",
              "'mod'", "'indie'", "'solo'", "'coop'", "'retro'", "'pixel'")
_TAG_OBJECT = "concat('{', concat_ws(', ', " + ", ".join(f"concat('\"', coalesce({t}, '-'), '\": {i}')" for i, t in enumerate(_TAG_NAMES)) + "), '}')"
_TAG_ARRAY = "concat('[', concat_ws(', ', " + ", ".join(f"concat('\"', coalesce({t}, '-'), '\"')" for t in _TAG_NAMES) + "), ']')"
_ITEM_COLUMNS = {
    "appid": "doc_id",
    "name": "case when n_chars < 60 then '  ' else concat('Item ', source, ' ', cast(doc_id as varchar(20))) end",
    "short_description": "case when lang = 'de' then '' when lang = 'es' then null else text end",
    "about_the_game": "case when lang = 'es' then null else concat('About: ', text) end",
    "detailed_description": "text",
    "release_date": "case when source = 'src4' then null else concat('20', lpad(cast(length(source) * 4 as varchar(20)), 2, '0')) end",
    "price": "case when source = 'src5' then null else n_chars / 8.0e0 end",
    "header_image": "concat(source, '.png')",
    "windows": "1",
    "mac": "case when lang = 'en' then 1 else 0 end",
    "linux": "case when lang = 'fr' then 1 when lang = 'de' then null else 0 end",
    "genres_json": "case when source = 'src3' then null when source = 'src7' then '{bad' else concat('[\"', lang, '\", \"', source, '\"]') end",
    "tags_json": f"case when source = 'src6' then null when lang = 'en' then {_TAG_OBJECT} else {_TAG_ARRAY} end",
    "positive": "case when quality = 1 then n_chars end",
    "negative": "case when toxic = 1 then n_chars when quality = 1 then 7 end",
}
_BASE = "(select d.doc_id, text, lang, source, n_chars, quality, toxic from documents d left join labels l on d.doc_id = l.doc_id)"
_SELECT = ", ".join(f"{sql} as {name}" for name, sql in _ITEM_COLUMNS.items())
ITEMS_SQL = f"items as (select {_SELECT} from {_BASE} b)"
_NAMED = "name is not null and trim(name) <> ''"
_TAG_LIST = "list_value(" + ", ".join(f"coalesce({t}, '-')" for t in _TAG_NAMES) + ")"

_REVIEW_COLUMNS = {
    "appid": "conv_id",
    "turn": "turn",
    "review": "text",
    "language": "case when role = 'system' then 'german' else 'english' end",
    "weighted_vote_score": "case when turn = 6 then 'n/a' else concat('0.', cast(9 - turn as varchar(20))) end",
    "votes_up": "length(text)",
    "voted_up": "case when role = 'assistant' and turn = 3 then 0 else 1 end",
}
_REVIEW_SELECT = ", ".join(f"{sql} as {name}" for name, sql in _REVIEW_COLUMNS.items())
REVIEWS_SQL = f"""rv as (select {_REVIEW_SELECT} from conversations),
 best as materialized (select * from (select *, row_number() over (partition by appid order by coalesce(try_cast(weighted_vote_score as double), 0) desc,
 votes_up desc, turn) as rn from rv where language = 'english' and length(trim(review, ' ')) > {P.min_review_chars} and voted_up = 1) where rn <= {P.reviews_per_item}),
 fb as (select appid, string_agg(review, '{P.review_separator}' order by rn) as feedback from best group by 1)"""


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogue items with JSON text columns, bad and missing ones among them."""
    documents = roles.table(spark, sf_dir, "documents")
    base = documents.join(roles.table(spark, sf_dir, "labels"), "doc_id", "left")
    rows = base.select(*[F.expr(sql).alias(name) for name, sql in _ITEM_COLUMNS.items()])
    empty = F.lit(None).cast("string")
    return rows.withColumns({"developers_json": empty, "publishers_json": empty, "categories_json": F.col("genres_json")})


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = roles.table(spark, sf_dir, "conversations")
    return rows.select(*[F.expr(sql).alias(name) for name, sql in _REVIEW_COLUMNS.items()])


@catalogue.add("w3_top_reviews", f"with {REVIEWS_SQL} select appid, rn, turn from best")
def top_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best reviews per item."""
    return docs.top_reviews(reviews(spark, sf_dir), P, "turn").select("appid", "rn", "turn")


@catalogue.add("w3_feedback", f"with {REVIEWS_SQL} select appid, feedback from fb")
def feedback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best reviews of an item as one text."""
    return docs.feedback(reviews(spark, sf_dir), P, "turn")


# List columns rebuilt from the base row instead of parsing JSON.
_PARSED = f"""pi as (select i.*, case when source in ('src3', 'src7') then [] else [lang, source] end as genres,
 case when source = 'src6' then [] else {_TAG_LIST} end as tags from items i join {_BASE} b on b.doc_id = i.appid where {_NAMED})"""
_DESC = "coalesce(nullif(short_description, ''), nullif(about_the_game, ''), '')"


@catalogue.add(
    "w3_documents",
    f"""with {ITEMS_SQL}, {REVIEWS_SQL}, {_PARSED} select cast(appid as varchar) as id, concat_ws(chr(10), concat('Title: ', name),
 case when len(genres) > 0 then concat('Genres: ', array_to_string(genres, ', ')) end,
 case when len(tags) > 0 then concat('Tags: ', array_to_string(tags[1:{P.document_tags}], ', ')) end,
 case when {_DESC} <> '' then concat('Description: ', case when length({_DESC}) > {P.description_chars} then concat(substr({_DESC}, 1, {P.description_chars}), '...') else {_DESC} end) end,
 case when feedback <> '' then concat('Player Feedback: ', substr(feedback, 1, {P.feedback_chars})) end) as document from pi left join fb using (appid)""",
)
def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document text per item."""
    return docs.documents(items(spark, sf_dir), reviews(spark, sf_dir), P, "turn")


META_SQL = f"""meta as materialized (select cast(appid as varchar) as app_id, name, substr(coalesce(short_description, ''), 1, {P.description_chars}) as short_description,
 genres, tags[1:{P.metadata_tags}] as tags, coalesce(price, 0.0e0) as price, coalesce(release_date, '') as release_date, header_image,
 windows = 1 as windows, mac = 1 as mac, coalesce(linux = 1, false) as linux, coalesce(positive, 0)::bigint as positive, coalesce(negative, 0)::bigint as negative from pi)"""


@catalogue.add(
    "w3_metadata",
    f"""with {ITEMS_SQL}, {_PARSED}, {META_SQL} select * replace ({r('price')} as price,
 case when len(genres) = 0 then '[]' else concat('["', array_to_string(genres, '","'), '"]') end as genres,
 case when len(tags) = 0 then '[]' else concat('["', array_to_string(tags, '","'), '"]') end as tags) from meta""",
)
def metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat metadata per item, lists as JSON text."""
    return docs.stored_metadata(docs.metadata(items(spark, sf_dir), P))


@catalogue.add(
    "w3_json_tags",
    f"""with {ITEMS_SQL}, {_PARSED} select appid, len(tags) as n_tags, array_to_string(tags, '|') as tags from pi""",
)
def json_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tag names parsed from objects, arrays, bad and missing JSON."""
    rows = files.named_items(items(spark, sf_dir))
    tags = json_names(F.col("tags_json"))
    return rows.select("appid", F.size(tags).alias("n_tags"), F.array_join(tags, "|").alias("tags"))


@catalogue.add(
    "w3_event_keys",
    """select event_type, json_extract(props, '$.k')::bigint as k, count(*) as n from events group by 1, 2""",
)
def event_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values held in the JSON text of the events."""
    parsed = F.from_json("props", "k BIGINT")
    return roles.table(spark, sf_dir, "events").groupBy("event_type", parsed["k"].alias("k")).agg(F.count(F.lit(1)).alias("n"))


@catalogue.add(
    "w3_first_items",
    f"""with {ITEMS_SQL}, {_PARSED} select cast(appid as varchar) as id, name, len(genres) as n_genres, len(tags) as n_tags, length(detailed_description) as n_chars
 from pi order by appid limit 100""",
)
def first_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First 100 named items by id, JSON columns parsed."""
    rows = docs.raw_items(files.first_items(items(spark, sf_dir), 100))
    return rows.select(
        "id", "name", F.size("genres").alias("n_genres"), F.size("tags").alias("n_tags"), F.length("detailed_description").alias("n_chars")
    )


# -- vectors -----------------------------------------------------------------------------------

FOUND_SQL = f"""vx as (select vec_id, embedding::double[] as x, sqrt(list_dot_product(embedding::double[], embedding::double[])) as len from embeddings),
 pairs as (select q.vec_id as query_id, i.vec_id as item_id, list_dot_product(q.x, i.x) / (q.len * i.len) as cos
 from vx q join vx i on q.vec_id <> i.vec_id),
 found as materialized (select query_id, item_id, cos, k as retrieval_rank, cast(printf('%.4f', (1 + cos) / 2) as double) as similarity from
 (select *, row_number() over (partition by query_id order by round(cos, 9) desc, item_id) as k from pairs) where k <= {P.candidates})"""


def found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearest other vectors of every vector."""
    rows = roles.table(spark, sf_dir, "embeddings")
    queries = rows.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vec"))
    vectors = rows.select(F.col("vec_id").alias("item_id"), F.col("embedding").alias("vec"))
    return rt.candidates(queries, vectors, P.candidates, exclude_same=True)


@catalogue.add(
    "w3_topk_cosine",
    f"with {FOUND_SQL} select query_id, item_id, retrieval_rank::int as retrieval_rank, {r('similarity')} as similarity from found",
)
def topk_cosine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact nearest items per query."""
    return found(spark, sf_dir)


@catalogue.add("w3_topk_approximate")
def topk_approximate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearest items per query from inverted lists of quantised vectors, best candidates scored exactly."""
    rows = roles.table(spark, sf_dir, "embeddings")
    queries = rows.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vec"))
    vectors = rows.select(F.col("vec_id").alias("item_id"), F.col("embedding").alias("vec"))
    near = approximate_nearest(queries, vectors, P.candidates, exclude_same=True)
    return near.select("query_id", "item_id", F.col("rank").alias("retrieval_rank"), rt.similarity(F.col("value")).alias("similarity"))


RANKED_SQL = f"""{ITEMS_SQL}, {_PARSED}, {META_SQL}, {FOUND_SQL},
 ranked as materialized (select * from (select *, row_number() over (partition by query_id order by score desc, retrieval_rank) as position from
 (select *, cast(printf('%.4f', similarity * {P.similarity_weight}::double + case when positive + negative > 0 then positive / (positive + negative) else {P.neutral_approval}::double end * {P.approval_weight}::double) as double) as score
 from found join meta on app_id = cast(item_id as varchar))) where position <= {P.matches})"""


def ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rt.rerank(found(spark, sf_dir), docs.metadata(items(spark, sf_dir), P), P)


@catalogue.add(
    "w3_rerank",
    f"with {RANKED_SQL} select query_id, position::int as position, app_id, {r('similarity')} as similarity, {r('score')} as score from ranked",
)
def rerank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blended ranking of the candidates."""
    return ranked(spark, sf_dir).select("query_id", "position", "app_id", "similarity", "score")


@catalogue.add(
    "w3_response",
    f"""with {RANKED_SQL} select query_id, position::int as position, app_id, name, {r('score')} as score, len(genres) as n_genres, len(tags) as n_tags,
 {r('price')} as price, release_date, concat('{P.store_page}', app_id) as store_page, windows, mac, linux from ranked""",
)
def response(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested responses, taken apart into one row per match."""
    nested = rt.responses(ranked(spark, sf_dir), P)
    flat = nested.select("query_id", F.inline("matches"))
    return flat.select(
        "query_id", "position", "app_id", "name", "score", F.size("genres").alias("n_genres"), F.size("tags").alias("n_tags"),
        "price", "release_date", "store_page", "platforms.windows", "platforms.mac", "platforms.linux",
    )


CONTEXT_SQL = f"""ctx as (select query_id, string_agg(concat(position, '. ', name, ' ($', printf('%.2f', price), ')', chr(10), '   Genres: ',
 case when len(genres) > 0 then array_to_string(genres, ', ') else 'N/A' end, ' | Tags: ', case when len(tags) > 0 then array_to_string(tags[1:{P.context_tags}], ', ') else 'N/A' end,
 chr(10), '   Approval: ', case when positive + negative > 0 then concat(printf('%.0f', positive / (positive + negative) * 100), '%') else 'N/A' end,
 ' (', format('{{:,}}', positive + negative), ' reviews)', chr(10), '   ', substr(short_description, 1, {P.context_chars})), concat(chr(10), chr(10)) order by position) as context,
 string_agg(name, ', ' order by position) filter (where position <= 3) as names from ranked group by 1)"""


@catalogue.add("w3_context", f"with {RANKED_SQL}, {CONTEXT_SQL} select query_id, context from ctx")
def context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Context text per query."""
    return rt.contexts(ranked(spark, sf_dir), P).select("query_id", "context")


@catalogue.add(
    "w3_prompts",
    f"""with {RANKED_SQL}, {CONTEXT_SQL}, qs as (select vec_id as query_id, concat('games like label ', label) as query from embeddings)
 select query_id, case when context is not null then '{SYSTEM_PROMPT}' end as system,
 case when context is not null then concat('User query: ', query, chr(10), chr(10), 'Retrieved games:', chr(10), context) end as user,
 case when context is null then '{P.no_match}' end as answer,
 case when context is not null then concat('Top matches: ', names, '.') end as fallback_answer from qs left join ctx using (query_id)""",
)
def prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages per query and the fallback answer."""
    rows = roles.table(spark, sf_dir, "embeddings")
    queries = rows.select(F.col("vec_id").alias("query_id"), F.concat(F.lit("games like label "), "label").alias("query"))
    return rt.prompts(queries, rt.contexts(ranked(spark, sf_dir), P), SYSTEM_PROMPT, P)


@catalogue.add("w3_text_search")
def text_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark texts searched among the item documents in one hashed term space."""
    texts = materialise(docs.documents(items(spark, sf_dir), reviews(spark, sf_dir), P, "turn"), "documents")
    model = rt.fit_text_vectors(texts, "document")
    vectors = rt.text_vectors(model, texts).select(F.col("id").cast("bigint").alias("item_id"), "vec")
    asked = roles.table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("document"))
    queries = rt.text_vectors(model, asked).select("query_id", "vec")
    return rt.candidates(queries, materialise(vectors, "vectors"), P.candidates)


# -- generated text -------------------------------------------------------------------------------

_WRAPPED = "case role when 'user' then concat('<think>', text, '</think> ', text) when 'assistant' then concat(text, ' <think>', text) else concat(chr(9), text, ' ') end"


@catalogue.add(
    "w3_clean_text",
    f"""select conv_id, turn, regexp_replace(regexp_replace(regexp_replace({_WRAPPED}, '(?s)<think>.*?</think>', '', 'g'), '(?s)<think>.*$', '', 'g'),
 '^\\s+|\\s+$', '', 'g') as answer from conversations""",
)
def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Generated text without reasoning blocks."""
    rows = roles.table(spark, sf_dir, "conversations")
    return rows.select("conv_id", "turn", strip_reasoning(F.expr(_WRAPPED)).alias("answer"))


@catalogue.add(
    "w3_valid_queries",
    """with q as (select conv_id, turn, regexp_replace(case when role = 'system' then concat(' ', chr(10)) else concat('  ', text) end, '^\\s+|\\s+$', '', 'g') as query from conversations)
 select query <> '' as accepted, count(*) as n, sum(length(query))::bigint as n_chars from q group by 1""",
)
def valid_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted and rejected queries after trimming."""
    rows = roles.table(spark, sf_dir, "conversations")
    text = F.when(F.col("role") == "system", F.lit(" \n")).otherwise(F.concat(F.lit("  "), F.col("text")))
    good, bad = docs.split_queries(rows.select("conv_id", "turn", text.alias("query")))
    both = good.withColumn("accepted", F.lit(True)).unionByName(bad.withColumn("accepted", F.lit(False)))
    return both.groupBy("accepted").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("query")).cast("bigint").alias("n_chars"))


@catalogue.add(
    "w3_upsert_latest",
    f"""with {ITEMS_SQL}, ch as (select doc_id as appid, concat('rated ', quality) as name, 1 as v from labels union all
 select doc_id, concat('toxic ', toxic), 2 from labels where toxic = 1),
 latest as (select appid, arg_max(name, v) as name from ch group by 1)
 select coalesce(i.appid, l.appid) as appid, coalesce(l.name, i.name) as name from items i full outer join latest l on i.appid = l.appid""",
)
def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored rows after a batch of changes, the last change of a key winning."""
    stored = items(spark, sf_dir).select("appid", "name")
    labels = roles.table(spark, sf_dir, "labels")
    first = labels.select(
        F.col("doc_id").alias("appid"), F.concat(F.lit("rated "), "quality").alias("name"), F.lit(1).alias("_version")
    )
    second = labels.filter("toxic = 1").select(
        F.col("doc_id").alias("appid"), F.concat(F.lit("toxic "), "toxic").alias("name"), F.lit(2).alias("_version")
    )
    return files.upsert_latest(stored, first.unionByName(second), "appid")


@catalogue.add("w3_collection_count", f"with {ITEMS_SQL} select count(*) as n_items from items where {_NAMED}")
def collection_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of stored items."""
    return files.named_items(items(spark, sf_dir)).agg(F.count(F.lit(1)).alias("n_items"))
