"""One query for each operator, over the whole of its table."""

import functools
import hashlib
import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arenalake.llm import quality_rules, toxicity
from arenalake.llm.conversation_trie import prefix_trie, turn_paths, with_openings
from arenalake.llm.decontaminate import contaminated
from arenalake.llm.filter_audit import audit
from arenalake.llm.fingerprints import neighbours
from arenalake.llm.jaccard_join import similar
from arenalake.llm.language import identify, learned
from arenalake.llm.packing import pack
from arenalake.llm.secret_scan import find_secrets, train
from arenalake.llm.store import shared_folder, ship
from arenalake.llm.substring_dedup import remove_repeated_passages
from arenalake.llm.suffix_dedup import remove_repeated_strings
from arenalake.llm.token_files import read_token_files, write_token_files

#: SQL of the same results, where SQL can express them.
ORACLES: dict[str, str] = {}
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
#: Where the public tokenizers lie; their files are never copied.
TOKENIZERS = os.environ.get("TOKENIZERS_DIR", "")


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @functools.wraps(function)
    def shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return function(spark, sf_dir)

    QUERIES[function.__name__] = shipped
    return shipped


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    if TOKENIZERS:
        return os.path.join(TOKENIZERS, name)
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens, with a checksum of their ids."""
    pieces = pack(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query
def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as read back from the token files."""
    folder = shared_folder(spark)
    write_token_files(table(spark, sf_dir, "documents"), folder, tokenizer_path("word_bpe_49k.json"))
    rows = read_token_files(spark, folder)
    return rows.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of secrets in every document; the models learn from all documents."""
    documents = table(spark, sf_dir, "documents")
    rows = find_secrets(documents, train(documents))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long")

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    base = F.filter("spans", lambda x: x["kind"] != "random")
    return rows.select(
        "doc_id",
        *(count(kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")),
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
        count("random").alias("n_random"),
    )


@query
def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint, against its edited text and the next document."""
    return neighbours(table(spark, sf_dir, "documents"))


def fold(folds: int) -> Column:
    """The part a document belongs to, by the checksum of its id."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(folds))


@query
def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from three quarters of them."""
    documents = table(spark, sf_dir, "documents")
    held_out = F.coalesce(fold(4) == 2, F.lit(False))
    samples = learned(documents.where(~held_out))
    return identify(documents, samples, held_out.alias("held_out"))


@query
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A toxicity score of every document, learned from two thirds of the labels."""
    documents = table(spark, sf_dir, "documents")
    held_out = F.coalesce(fold(3) == 1, F.lit(False))
    model = toxicity.train(documents, table(spark, sf_dir, "labels").where(~held_out))
    rows = toxicity.score(documents, model, held_out.alias("held_out"))
    return rows.select(
        "doc_id",
        "held_out",
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
        F.array_join(
            F.transform("spans", lambda x: F.concat_ws(":", x["start"], x["end"])), ","
        ).alias("spans"),
    )


def sha256(content: bytes) -> str:
    return hashlib.sha256(content).hexdigest()


def removed() -> Column:
    return F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])


@query
def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document without those of strings of 100 bytes that start earlier."""
    rows = remove_repeated_strings(table(spark, sf_dir, "documents"), kept=sha256, kept_type="string")
    return rows.select(
        "doc_id",
        F.col("n").alias("n_bytes"),
        removed().alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.col("kept").alias("kept_sha256"),
    )


@query
def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document without those of windows of 50 words that an earlier document holds."""
    rows = remove_repeated_passages(table(spark, sf_dir, "documents"), kept=sha256, kept_type="string")
    return rows.select(
        "doc_id", F.col("n").alias("n_words"), removed().alias("n_removed"), F.col("kept").alias("kept_sha256")
    )


ORACLES["op8_suffix_dedup"] = r"""
with docs as (select doc_id, hex(encode(coalesce(text, ''))) as b from documents),
windows as (
  select doc_id, i, md5(substring(b, 2 * i + 1, 200)) as h
  from (select doc_id, b, unnest(generate_series(0, length(b) // 2 - 100)) as i from docs where length(b) >= 200)),
firsts as (select h, min((doc_id, i)) as first_place from windows group by h),
repeats as (select doc_id, i from windows join firsts using (h) where (doc_id, i) > first_place),
marked as (
  select doc_id, i, coalesce(i > lag(i) over (partition by doc_id order by i) + 100, true)::int as new from repeats),
spans as (
  select doc_id, min(i) as s, max(i) + 100 as e
  from (select doc_id, i, sum(new) over (partition by doc_id order by i) as k from marked) group by doc_id, k),
cuts as (select doc_id, s, e, lag(e, 1, 0) over (partition by doc_id order by s) as p from spans),
heads as (
  select doc_id, sum(e - s) as n_removed, count(*) as n_spans, max(e) as last_end,
    string_agg(substring(b, 2 * p + 1, 2 * (s - p)), '' order by s) as head
  from cuts join docs using (doc_id) group by doc_id)
select docs.doc_id, (length(b) // 2)::bigint as n_bytes, coalesce(n_removed, 0)::bigint as n_removed,
  coalesce(n_spans, 0) as n_spans,
  sha256(unhex(coalesce(head, '') || substring(b, 2 * coalesce(last_end, 0) + 1))) as kept_sha256
from docs left join heads using (doc_id)
"""

ORACLES["op9_substring_dedup"] = r"""
with docs as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
windows as (
  select doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) as h
  from (select doc_id, w, unnest(generate_series(1, len(w) - 49)) as i from docs where len(w) >= 50)),
firsts as (select h, min(doc_id) as first_id from windows group by h),
gone as (
  select distinct doc_id, unnest(generate_series(i, i + 49)) as place
  from windows join firsts using (h) where doc_id > first_id),
words as (select doc_id, unnest(w) as word, generate_subscripts(w, 1) as place from docs),
kept as (
  select words.doc_id, count(gone.place) as n_removed,
    string_agg(word, ' ' order by words.place) filter (where gone.place is null) as text
  from words left join gone on gone.doc_id = words.doc_id and gone.place = words.place group by words.doc_id)
select docs.doc_id, len(w)::bigint as n_words, coalesce(n_removed, 0) as n_removed, sha256(coalesce(kept.text, '')) as kept_sha256
from docs left join kept on kept.doc_id = docs.doc_id
"""


@query
def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's number of 5-word shingles and its component of documents alike to 0.8 and more."""
    return similar(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


_WORDS = r"""regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"""
ORACLES["op4_jaccard_join"] = f"""
with recursive words as (select doc_id, {_WORDS} as w from documents),
shingles as (
  select doc_id, unnest(list_distinct(case when len(w) = 0 then []::varchar[] when len(w) < 5 then [array_to_string(w, ' ')]
    else list_transform(generate_series(1, len(w) - 4), lambda i: array_to_string(w[i:i + 4], ' ')) end)) as s
  from words),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
pairs as (
  select a.doc_id as x, b.doc_id as y, count(*) as common
  from shingles a join shingles b on a.s = b.s and a.doc_id < b.doc_id group by 1, 2),
links as (
  select x, y from pairs join sizes p on p.doc_id = x join sizes q on q.doc_id = y
  where 100 * common >= 80 * (p.n + q.n - common)),
edges as (select x, y from links union all select y, x from links),
reach as (select doc_id as x, doc_id as y from documents union select r.x, e.y from reach r join edges e on r.y = e.x)
select d.doc_id, coalesce(any_value(sizes.n), 0) as n_shingles, min(reach.y) as component_id
from documents d left join sizes on sizes.doc_id = d.doc_id left join reach on reach.x = d.doc_id
group by d.doc_id
"""


@query
def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item found in a document, in any case, with its numbers, names and units changed or not."""
    documents, benchmark = (table(spark, sf_dir, x) for x in ("documents", "benchmark"))
    return contaminated(documents, benchmark)


@query
def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of all conversations, each begun like the first of its hundred."""
    paths = turn_paths(table(spark, sf_dir, "conversations"))
    taken = F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(6))
    return prefix_trie(with_openings(paths, 100, 5, taken))


#: The checksum of a conversation id's decimal digits; a step of -1 shifts by one bit.
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295::bigint, flatten(list_transform(
    string_split(conv_id::varchar, ''), lambda c: [ascii(c)::bigint, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda c, x: case when x >= 0 then xor(c, x) when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end))"""
ORACLES["op11_conversation_trie"] = f"""
with own as (
  select conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}}
    order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as turns
  from conversations where conv_id is not null group by conv_id),
sized as (select conv_id, turns, ({_CRC} % 6)::bigint as h from own),
rebuilt as (
  select c.conv_id, list_concat(coalesce(o.turns, [])[1:c.h], c.turns[c.h + 1:]) as turns
  from sized c left join own o on o.conv_id = c.conv_id - c.conv_id % 100),
member as (
  select conv_id, d, turns[1:d] as path, len(turns) = d as ends
  from (select conv_id, turns, unnest(generate_series(0, len(turns))) as d from rebuilt)),
nodes as (
  select path, any_value(d) as depth, min(conv_id) as conv_id, count(*) as n_convs,
    sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (where ends), '')) as ends_sha256
  from member group by path),
kids as (select path[1:depth - 1] as path, count(*) as n_children from nodes where depth > 0 group by 1),
family as (
  select n.*, coalesce(k.n_children, 0) as n_children,
    case when n.depth = 0 then 0 else (n.n_convs - 1) * length(n.path[n.depth].text) end as saved
  from nodes n left join kids k on k.path = n.path),
upward as (
  select path[1:a] as path, n_children, saved
  from (select path, n_children, saved, unnest(generate_series(0, depth)) as a from family)),
sums as (
  select path, count(*) filter (where n_children = 0) as n_leaves, sum(saved)::bigint as saved_tokens
  from upward group by path)
select f.conv_id, f.depth::bigint as depth, p.conv_id as parent_conv_id, f.n_convs, f.n_children, s.n_leaves,
  s.saved_tokens, f.ends_sha256
from family f join sums s on s.path = f.path
left join family p on f.depth > 0 and p.path = f.path[1:f.depth - 1]
"""


@query
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of five filters removes in every order, for each language."""
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLES["op12_filter_audit"] = r"""
with recursive texts as (
  select doc_id, coalesce(lang, '') as part, coalesce(text, '') as t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w
  from documents),
marked as (
  select texts.doc_id, part, [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w),
    100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t), regexp_matches(t, '[#$%&*|]'),
    doc_id > min(doc_id) over (partition by t)] as fails
  from texts),
judged as (
  select marked.*, coalesce(l.good, false) as good, coalesce(l.toxic, false) as toxic
  from marked left join (select doc_id, bool_or(quality = 1) as good, bool_or(toxic = 1) as toxic from labels group by doc_id) l
    on l.doc_id = marked.doc_id),
letters as (select unnest(['A', 'B', 'C', 'D', 'E']) as x),
orders(o) as (
  select '' union all
  select o || x from orders, letters where length(o) < 5 and not contains(o, x)),
steps as (
  select o as filter_order, unnest(generate_series(1, 5)) as step from orders where length(o) = 5),
tested as (
  select part, good, toxic, filter_order, step::int as step,
    fails[ascii(filter_order[step]) - 64] as now,
    list_bool_or(list_transform(generate_series(1, step - 1), lambda i: fails[ascii(filter_order[i]) - 64])) as before,
    len(list_filter(fails, lambda f: f)) as n_fails
  from judged, steps),
counted as (
  select part, filter_order, step, count(*) filter (where not coalesce(before, false) and not now) as kept,
    count(*) filter (where not coalesce(before, false) and now) as removed,
    count(*) filter (where before and now) as redundant,
    count(*) filter (where now and n_fails = 1) as unique_fails,
    count(*) filter (where not coalesce(before, false) and now and good) as good_lost,
    count(*) filter (where not coalesce(before, false) and now and toxic) as toxic_lost
  from tested group by all)
select *, (sum(removed) over (partition by part, filter_order[step]))::bigint as shapley from counted
"""


@query
def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quality score of every document, learned from two thirds of the labels."""
    documents = table(spark, sf_dir, "documents")
    held_out = F.coalesce(fold(3) == 1, F.lit(False))
    model = quality_rules.train(documents, table(spark, sf_dir, "labels").where(~held_out))
    rows = quality_rules.score(documents, model, held_out.alias("held_out"))
    return rows.select("doc_id", "held_out", "score", (F.col("score") >= quality_rules.THRESHOLD).cast("int").alias("predicted"))
