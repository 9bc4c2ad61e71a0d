"""Registered queries of the subpackage: (spark, directory of the given tables) -> DataFrame."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlake.llm import chat, decontaminate, language, mixing, pii, ppm, prefix_trie, quality, repair, repeats, secret_scan, simhash, topk
from visitlake.llm.digests import ordered_sha256
from visitlake.sources.files import staged

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op5_simhash_groups(spark, sf):
    groups = simhash.simhash_groups(table(spark, sf, "documents"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op7_language_id(spark, sf):
    return language.identify_languages(table(spark, sf, "documents"))


def _chat_digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What the formatted conversations say, read back from text, offsets and mask alone."""
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for batch in batches:
        rows = []
        for text, *lists in zip(batch.column(1).to_pylist(), *(batch.column(n) for n in (2, 3, 4))):
            starts, ends, mask = (x.values.to_numpy(zero_copy_only=False) for x in lists)
            turns = chat.parse(text)
            regions = chat.masked_regions(starts, ends, mask)
            loss = "".join(chat.unescape(text[a:b]) for a, b in regions)
            rows.append((len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss), len(text)))
        names = ("n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
        columns = {name: list(values) for name, values in zip(names, zip(*rows))}
        if rows:
            yield pa.RecordBatch.from_pydict({"conv_id": batch.column(0), **columns})


@query
def op2_chat_format(spark, sf):
    hard = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", hard), (-7, 1, "assistant", hard)], "conv_id bigint, turn bigint, role string, text string")
    turns = table(spark, sf, "conversations").select(extra.columns).unionByName(extra)
    formatted = chat.format_conversations(turns).drop("token_ids")
    return formatted.mapInArrow(
        _chat_digest,
        "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint",
    )


# The marks and separator of a turn are 15 characters for the assistant's and 21 for others, plus one per escape.
_ESCAPES = r"""'[<\[]\\*(s>|/s>|INST\]|/INST\]|\|text\|>|\|endoftext\|>)'"""
ORACLES["op2_chat_format"] = f"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]' union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]')
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
  cast(sum(case when role = 'assistant' then length(text) else 0 end) as bigint) as loss_chars,
  sha256(string_agg(case when role = 'assistant' then text else '' end, '' order by turn nulls first, role, text)) as loss_sha256,
  cast(sum(case when role = 'assistant' then 15 else 21 end + length(role) + length(text)
    + len(regexp_extract_all(role, {_ESCAPES})) + len(regexp_extract_all(text, {_ESCAPES}))) as bigint) as formatted_chars
from turns group by conv_id
"""


@query
def op9_exact_top_k(spark, sf):
    vectors = topk.quantized(table(spark, sf, "embeddings"))
    return topk.top_k(vectors, vectors.filter("id % 20 = 0"))


ORACLES["op9_exact_top_k"] = """
with v as (
  select distinct vec_id, list_transform(embedding, lambda x: cast(floor(64 * cast(x as double)) as bigint)) as v from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = len(embedding)),
scored as (
  select q.vec_id as query_id, c.vec_id,
    cast(list_inner_product(cast(q.v as double[]), cast(c.v as double[])) as bigint) as score
  from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 20 = 0),
ranked as (
  select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as int) as rank from scored)
select query_id, rank, vec_id, score from ranked where rank <= 20
"""


@query
def op10_secret_scan(spark, sf):
    return secret_scan.secret_digest(secret_scan.scan_secrets(table(spark, sf, "documents")))


@query
def op1_personal_data(spark, sf):
    return pii.personal_data_digest(pii.find_personal_data(table(spark, sf, "documents")))


@query
def op4_lm_scores(spark, sf):
    return ppm.score_texts(table(spark, sf, "documents"), order=ppm.DEEP_ORDER)


@query
def op6_quality_scores(spark, sf):
    return quality.score_quality(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query
def op3_benchmark_leaks(spark, sf):
    return decontaminate.find_contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query
def op8_source_mix(spark, sf):
    return mixing.mix_sources(table(spark, sf, "documents"))


# The exponents come from 40 halvings of [0, 1]; both are rounded as the operator rounds its own.
MIX_SQL = """
with recursive
docs as (
  select doc_id, source, n_tokens, ('0x' || substr(md5(concat_ws(':', 'mix', coalesce(source, ''), coalesce(cast(doc_id as varchar), ''), coalesce(text, ''))), 1, 15))::bigint as place
  from (select doc_id, source, text, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) as n_tokens from {documents}) t
  where n_tokens > 0),
totals as (select source, cast(sum(n_tokens) as bigint) as tokens from docs group by source),
sizes as (select cast(sum(tokens) as bigint) as t, count(*) as n, min(tokens) as least, list(ln(tokens / s.total)) as logs
  from totals, (select cast(sum(tokens) as double) as total from totals) s),
halves(k, a, b, c, d) as (
  select 0, 0.0::double, 1.0::double, 0.0::double, 1.0::double
  union all
  select k + 1, if(enough, (a + b) / 2, a), if(enough, b, (a + b) / 2), if(often, (c + d) / 2, c), if(often, d, (c + d) / 2)
  from (select *,
      ln(list_sum(list_transform(logs, lambda l: exp((a + b) / 2 * l))))
        - (a + b) / 2 * list_sum(list_transform(logs, lambda l: l * exp((a + b) / 2 * l))) / list_sum(list_transform(logs, lambda l: exp((a + b) / 2 * l)))
        >= 0.999 * ln(n) as enough,
      exp(((c + d) / 2 - 1) * ln(least / t)) / list_sum(list_transform(logs, lambda l: exp((c + d) / 2 * l))) > 4 as often
    from halves, sizes where k < 40)),
exponent as (
  select case when n = 1 then 1.0 else greatest(
    round(a, 6), round(c, 6)) end as e from halves, sizes where k = 40),
weighted as (select source, tokens, t, pow(tokens / t, e) as w from totals, sizes, exponent),
plan as (
  select source, tokens, cast(round(w / (sum(w) over ()) * t) as bigint) as quota, greatest(1, cast(ceil(t / 100000.0) as bigint)) as blocks
  from weighted),
placed as (
  select d.*, p.tokens, p.quota, p.blocks, coalesce(sum(n_tokens) over (partition by d.source order by place, doc_id, n_tokens
    rows between unbounded preceding and 1 preceding), 0) as before
  from docs d join plan p on d.source is not distinct from p.source),
uses as (
  select *, unnest(range(cast(ceil((quota - before) / tokens) as bigint))) as copy from placed where before < quota),
dealt as (
  select cast(least(floor((copy * tokens + before) / quota * blocks), blocks - 1) as bigint) as block, doc_id, source, cast(copy as int) as copy, n_tokens from uses)
select block, cast(row_number() over (partition by block order by
    ('0x' || substr(md5(concat_ws(':', 'mix', cast(block as varchar), coalesce(source, ''), coalesce(cast(doc_id as varchar), ''), cast(copy as varchar))), 1, 15))::bigint,
    doc_id, copy, n_tokens) as int) as position, doc_id, source, copy, n_tokens
from dealt
"""
ORACLES["op8_source_mix"] = MIX_SQL.replace("{documents}", "documents")


# CRC-32 of {text} by its bits, for texts of ASCII characters.
CRC32 = """xor(4294967295, list_reduce(list_concat([4294967295::bigint], list_transform(range(length({text})), lambda n: ord(({text})[n + 1])::bigint)),
  lambda c, b: list_reduce(list_concat([xor(c, b)], [0::bigint, 0, 0, 0, 0, 0, 0, 0]), lambda x, z: case when x % 2 = 1 then xor(x // 2, 3988292384::bigint) else x // 2 end)))"""


@query
def op11_prefix_trie(spark, sf):
    nodes, ends = prefix_trie.prefix_trie(table(spark, sf, "conversations"))
    # ids of a node by thousands, so that a row of its list is short however many members end there
    thousand = F.floor(F.col("conv_id") / 1000).alias("thousand")
    lists = ends.groupBy("k1", "k2", thousand).agg(F.concat_ws(",", F.expr("transform(array_sort(collect_list(conv_id)), x -> cast(x as string))")).alias("ids"))
    digests = ordered_sha256(lists, ["k1", "k2"], "thousand", "ids", ",")
    none = F.lit(hashlib.sha256().hexdigest())
    joined = nodes.join(digests, ["k1", "k2"], "left").withColumn("ends_sha256", F.coalesce("sha256", none))
    return joined.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    )


ORACLES["op11_prefix_trie"] = f"""
with own as (
  select conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}} order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as t
  from conversations where conv_id is not null group by conv_id),
lent as (select conv_id, conv_id - conv_id % 5 as base, {CRC32.format(text="conv_id::varchar")} % 9 as h, t from own),
rebuilt as (select l.conv_id, list_concat(coalesce(b.t, [])[1:l.h], l.t[l.h + 1:]) as t from lent l left join own b on b.conv_id = l.base),
steps as (select conv_id, unnest(range(len(t) + 1)) as d, t from rebuilt),
nodes as (
  select d, t[1:d] as p, min(conv_id) as conv_id, count(*) as n_convs, coalesce(strlen(any_value(t)[d].text), 0) as bytes,
    string_agg(case when len(t) = d then conv_id::varchar end, ',' order by conv_id) as ends from steps group by 1, 2),
children as (select d - 1 as d, p[1:d - 1] as p, count(*) as n from nodes where d > 0 group by 1, 2),
valued as (
  select n.*, coalesce(c.n, 0) as n_children, cast(c.n is null as bigint) as leaf, (n_convs - 1) * bytes as saved
  from nodes n left join children c using (d, p)),
tops as (select unnest(range(d + 1)) as up, p, leaf, saved from valued),
sums as (select up as d, p[1:up] as p, cast(sum(leaf) as bigint) as n_leaves, cast(sum(saved) as bigint) as saved_tokens from tops group by 1, 2)
select v.conv_id, v.d as depth, f.conv_id as parent_conv_id, v.n_convs, v.n_children, s.n_leaves, s.saved_tokens, sha256(coalesce(v.ends, '')) as ends_sha256
from valued v join sums s using (d, p) left join nodes f on f.d = v.d - 1 and f.p = v.p[1:v.d - 1]
"""


@query
def op12_structure_repair(spark, sf):
    rows, _ = staged(repair.repair_conversations(table(spark, sf, "conversations")), "repaired-turns")
    lines = rows.filter("edit <> 'D'").select(
        F.col("conv_id").isNull().alias("absent"), F.coalesce("conv_id", F.lit(0)).alias("conv"), "place", F.concat("role", F.lit(":"), "text").alias("line")
    )
    digests = ordered_sha256(lines, ["absent", "conv"], "place", "line", "\n")
    digests = digests.select(F.when(~F.col("absent"), F.col("conv")).alias("of"), "sha256")
    reports = rows.filter("place = 0")
    joined = reports.join(digests, F.col("conv_id").eqNullSafe(F.col("of")), "left")
    return joined.select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
        F.coalesce("sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )


def _least(*ways: str) -> str:
    return f"list_min([{', '.join(ways)}])"


def _way(before: str, cost: str, letter: str, line: str) -> str:
    """A way one edit longer: cost, edits, text so far; null where the way before is."""
    return f"{{'c': {before}.c + {cost}, 'e': {before}.e || '{letter}', 't': {before}.t || {line}}}"


def _if(condition: str, way: str) -> str:
    return f"case when {condition} then {way} end"


def _inserted(state: str, *others: str) -> str:
    """The best way to a state, with an empty turn inserted after one of the others where that is better."""
    role = {"vu": "user", "va": "assistant"}[state]
    return _least(state, *(_if(f"{o} is not null", _way(o, "5", "I", f"'{role}:' || chr(10)")) for o in others))


# All best ways to each state (nothing, system, user or assistant written last), row by row.
_ROW = "role || ':' || text || chr(10)"
_DELETED = lambda v: _if(f"{v} is not null", _way(v, "2", "D", "''"))
_KEPT = lambda v, role: _if(f"{v} is not null and whole and left(role, 1) = '{role[0]}'", _way(v, "late", "K", _ROW))
_REROLED = lambda v, role: _if(f"{v} is not null and whole", _way(v, "late + 1", "R", f"'{role}:' || text || chr(10)"))
ORACLES["op12_structure_repair"] = f"""
with recursive
cased as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
    {CRC32.format(text="(coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '))")} % 20 as k from conversations),
damaged as (
  select conv_id, turn, case when k = 4 then 'user' else role end as role,
    case k when 1 then '' when 2 then translate(text, '.!?', '') else text end as text,
    unnest(range(case when k = 3 then 2 else 1 end)) as copy from cased where k <> 0),
placed as (select *, row_number() over (partition by conv_id order by turn nulls first, role, text, copy) as pos from damaged),
judged as (
  select *, case when not regexp_matches(text, '[^\\x20\\x09-\\x0D]') then 'blank'
      when row_number() over (partition by conv_id, role, text order by pos) > 1 then 'duplicate'
      when not regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') then 'truncated' else '' end as fault,
    lag(left(role, 1)) over (partition by conv_id order by pos) || left(role, 1) as pair from placed),
counted as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count_if(fault = 'blank') as blank,
    count_if(fault = 'duplicate') as duplicate, count_if(fault = 'truncated') as truncated,
    count_if(pair not in ('su', 'ua', 'au')) as illegal, count(*) as n from judged group by conv_id),
convs as (select conv_id, coalesce(n, 0) as n, c.* exclude (conv_id, n) from (select distinct conv_id from conversations) o
  left join counted c on c.conv_id is not distinct from o.conv_id),
ways(conv_id, n, pos, v0, vs, vu, va) as (
  select o.conv_id, coalesce(c.n, 0), 0::bigint, {{'c': 0::bigint, 'e': '', 't': ''}}, null::struct(c bigint, e varchar, t varchar),
    {{'c': 5::bigint, 'e': 'I', 't': 'user:' || chr(10)}}, {{'c': 10::bigint, 'e': 'II', 't': 'user:' || chr(10) || 'assistant:' || chr(10)}}
  from (select distinct conv_id from conversations) o left join counted c on c.conv_id is not distinct from o.conv_id
  union all
  select conv_id, n, pos, v0, vs, vu, {_inserted("va", "vu")} from (
  select conv_id, n, pos, v0, vs, {_inserted("vu", "v0", "vs", "va")} as vu, va from (
  select w.conv_id, w.n, j.pos, {_DELETED("v0")} as v0, {_least(_DELETED("vs"), _KEPT("v0", "system"))} as vs,
    {_least(_DELETED("vu"), *(f("" + v, "user") for v in ("v0", "vs", "va") for f in (_KEPT, _REROLED)))} as vu,
    {_least(_DELETED("va"), _KEPT("vu", "assistant"), _REROLED("vu", "assistant"))} as va
  from (select *, case when fault = 'truncated' then 5 else 0 end as late, fault not in ('blank', 'duplicate') as whole from judged) j
  join ways w on j.conv_id is not distinct from w.conv_id and j.pos = w.pos + 1) a) b),
best as (select conv_id, {_least("v0", "va")} as v from ways where pos = n)
select o.conv_id, coalesce(c.gaps, 0) as gaps, coalesce(c.blank, 0) as blank, coalesce(c.duplicate, 0) as duplicate,
  coalesce(c.truncated, 0) as truncated, coalesce(c.illegal, 0) as illegal, v.c as cost, v.e as audit,
  sha256(coalesce(left(v.t, length(v.t) - 1), '')) as repaired_sha256
from best o left join counted c on c.conv_id is not distinct from o.conv_id
"""


@query
def op13_repeated_passages(spark, sf):
    left = repeats.remove_repeats(table(spark, sf, "documents"))
    removed = F.expr("aggregate(removed, 0L, (n, x) -> n + x.end - x.first)")
    return left.select("doc_id", "n_words", removed.alias("n_removed"), F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


ORACLES["op13_repeated_passages"] = """
with docs as (
  select doc_id, row_number() over () as row, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as w from documents),
windows as (select doc_id, row, s, md5(array_to_string(w[s:s + 19], ' ')) as k from (select *, unnest(range(1, len(w) - 18)) as s from docs) t),
judged as (select *, min(doc_id) over (partition by k) as d, min(s) over (partition by k, row) as f from windows),
gone as (select distinct row, unnest(range(s, s + 20)) as n from judged where d is distinct from doc_id or f < s),
lists as (select row, list(n) as gone from gone group by row)
select doc_id, len(w) as n_words, len(coalesce(gone, [])) as n_removed,
  sha256(array_to_string(case when gone is null then w else list_filter(w, lambda x, i: not list_contains(gone, i)) end, ' ')) as kept_sha256
from docs left join lists using (row)
"""
