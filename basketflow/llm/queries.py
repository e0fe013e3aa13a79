"""The thin queries over the given tables, one per operator, and their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import functions as F

from basketflow.llm.common import Stages

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(f):
        QUERIES[name] = f
        if sql:
            ORACLE_SQL[name] = sql
        return f
    return register


def _table(spark, sf_dir: str, name: str):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _sha(col):
    return F.sha2(F.coalesce(col, F.lit("")).cast("binary"), 256)


_OP1 = r"""
with w as (select doc_id, case when len(coalesce(text, '')) = 0 then []::varchar[]
             else regexp_extract_all(text, '[^\x20\x09-\x0D]+') end ws from documents),
starts_at as (select doc_id, ws, unnest(range(1, len(ws) - 48)) i from w where len(ws) >= 50),
win as (select doc_id, i, array_to_string(ws[i : i + 49], ' ') k from starts_at),
lowest as (select k, min(doc_id) d from win group by k),
starts as (select win.doc_id, list(win.i) starts from win join lowest using (k) where win.doc_id > lowest.d group by 1),
covered as (select doc_id, list(distinct p) gone from (select doc_id, unnest(range(s, s + 50)) p from
              (select doc_id, unnest(starts) s from starts)) group by 1),
kept as (select w.doc_id, len(ws) n_words, coalesce(len(gone), 0) n_removed,
           array_to_string(case when gone is null then ws
             else [ws[p] for p in range(1, len(ws) + 1) if not list_contains(gone, p)] end, ' ') t
         from w left join covered using (doc_id))
select doc_id, n_words::bigint n_words, n_removed::bigint n_removed, sha256(t) kept_sha256 from kept
"""


@query("op1_substring_dedup", _OP1)
def op1_substring_dedup(spark, sf_dir):
    from basketflow.llm import substring_dedup as sd
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return sd.dedup(docs, Stages(spark, "op1")).drop("spans")


@query("op2_secret_scan")
def op2_secret_scan(spark, sf_dir):
    from basketflow.llm import secrets as sc
    stages = Stages(spark, "op2")
    ledger = sc.Ledger(spark, stages.path("ledger"))
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    paths = sc.update(docs, ledger, stages, path="doc_id")
    found = sc.findings(paths, ledger)
    of = lambda name: F.size(F.filter("spans", lambda s: s["rule"] == name)).cast("long")
    # Every rule is a base rule, so the base spans are all spans.
    spans = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["rule"], s["start"], s["end"])), ",")
    return found.select(F.col("path").alias("doc_id"), of("assign").alias("n_assign"), of("access").alias("n_access"),
                        of("hex").alias("n_hex"), _sha(spans).alias("base_sha256"), spans.alias("spans"))


@query("op3_language_filters")
def op3_language_filters(spark, sf_dir):
    from basketflow.llm import langid
    docs = _table(spark, sf_dir, "documents")
    model = langid.fit(docs.where(F.col("doc_id").isNotNull() & ~langid.held_out(F.col("doc_id"))), Stages(spark, "op3"))
    rows = docs.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "text")
    return langid.predict(rows, model).drop("text")


@query("op4_quality_llr")
def op4_quality_llr(spark, sf_dir):
    from basketflow.llm import quality as ql
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = ql.judge(docs, ql.fit(docs, _table(spark, sf_dir, "labels")))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "score", "kept")


_OP5 = """
with m as (select distinct conv_id, turn, role, text from conversations),
who as (select distinct conv_id, role perspective from m where role is not null and role <> 'system'),
seen as (select m.conv_id, perspective, turn, coalesce(role = perspective, false) own,
           md5(concat_ws(chr(31), coalesce(role, chr(30)), coalesce(text, chr(30)))) tie,
           case when role = perspective then '<|assistant|>' || chr(10) when role = 'system' then '<|system|>' || chr(10)
             else '<|user:' || replace(coalesce(role, ''), '<|', '< |') || '|>' || chr(10) end head,
           replace(coalesce(text, ''), '<|', '< |') || '<|end|>' body
         from m join who using (conv_id)),
placed as (select *, coalesce(sum(len(head) + len(body) + 1) over (partition by conv_id, perspective order by turn nulls first, tie
         rows between unbounded preceding and 1 preceding), 0)::bigint before from seen)
-- One block: no conversation here reaches 64 turns.
select conv_id, perspective, 0::bigint block, 0::bigint "start", count(*)::bigint n_messages,
  string_agg(head || body || chr(10), '' order by turn nulls first, tie) as text,
  string_agg((before + len(head))::varchar || '-' || (before + len(head) + len(body))::varchar, ',' order by turn nulls first, tie)
    filter (own) mask
from placed group by conv_id, perspective
"""


@query("op5_perspectives", _OP5)
def op5_perspectives(spark, sf_dir):
    from basketflow.llm import perspectives as pv
    out = pv.rotate(_table(spark, sf_dir, "conversations"))
    return out.withColumn("mask", F.array_join(F.transform("mask", lambda m: F.concat_ws("-", m["start"], m["end"])), ","))


@query("op6_simhash_vp")
def op6_simhash_vp(spark, sf_dir):
    from basketflow.llm import simhash_vp as sv
    found = sv.near_duplicates(_table(spark, sf_dir, "documents").select("doc_id", "text"), Stages(spark, "op6"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


_SIZES = r"""
sizes as (select doc_id, source, text,
            len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint size from documents),
by_source as (select source, sum(size)::bigint source_size from sizes group by source),
turned as (select *, row_number() over (order by source nulls last) - 1 turn from by_source),
weighed as (select *, (case turn % 3 when 0 then 3.0 when 1 then 1.0 else 2.0 end)::double weight,
              (case turn % 3 when 0 then 2.0 when 1 then 1.0 else 1.0 end)::double a,
              (case turn % 3 when 0 then 1.0 when 1 then 1.0 else 3.0 end)::double b from turned),
-- Sources reach their cap in the order of cap / weight: the level is what is left for the open ones.
ranked as (select *, coalesce(sum(2.0 * source_size) over (order by 2.0 * source_size / weight, turn
                       rows between unbounded preceding and 1 preceding), 0.0) capped,
             sum(weight) over (order by 2.0 * source_size / weight, turn
                       rows between current row and unbounded following) open_weight,
             1.5 * sum(source_size) over () wanted from weighed),
level as (select arg_min((wanted - capped) / open_weight, 2.0 * source_size / weight) filter ((wanted - capped) / open_weight < 2.0 * source_size / weight) l from ranked),
goals as (select source, source_size, a, b, least(2.0 * source_size, coalesce(l, 1e300) * weight)::double target from weighed, level)
"""

_OP7 = f"""
with {_SIZES},
placed as (select s.doc_id, s.size, s.source, g.source_size, g.target, g.a, g.b,
             sum(s.size) over (partition by s.source order by md5(s.doc_id::varchar), s.size
                               rows between unbounded preceding and current row)::bigint - s.size / 2.0 middle
           from sizes s join goals g on s.source is not distinct from g.source),
taken as (select *, case when size = 0 then 0 else floor(target / source_size)::bigint
            + (middle < target - floor(target / source_size) * source_size)::bigint end copies from placed)
select doc_id, size, source_size, target, (copies * size)::bigint taken, copies::bigint copies,
  case when copies > 0 then case when a = b then u else (sqrt(a * a + (b - a) * (a + b) * u) - a) / (b - a) end end first_position
from (select *, case when copies > 0 then least(1.0::double, middle / target) end u from taken)
"""


@query("op7_curriculum_mix", _OP7)
def op7_curriculum_mix(spark, sf_dir):
    from basketflow.llm import curriculum as cu
    planned = cu.plan(cu.doc_sizes(_table(spark, sf_dir, "documents")), Stages(spark, "op7"))
    return planned.select("doc_id", "size", "source_size", "target", "taken", "copies", F.get("positions", F.lit(0)).alias("first_position"))


_OP7_ORDER = f"""
with {_SIZES},
placed as (select s.doc_id, s.size, s.source, g.source_size, g.target, g.a, g.b,
             sum(s.size) over (partition by s.source order by md5(s.doc_id::varchar), s.size
                               rows between unbounded preceding and current row)::bigint - s.size / 2.0 middle
           from sizes s join goals g on s.source is not distinct from g.source),
taken as (select *, case when size = 0 then 0 else floor(target / source_size)::bigint
            + (middle < target - floor(target / source_size) * source_size)::bigint end copies from placed),
each as (select *, unnest(range(0, copies)) "copy" from taken),
share as (select *, least(1.0::double, ("copy" * source_size + middle) / target) u from each),
timed as (select *, case when a = b then u else (sqrt(a * a + (b - a) * (a + b) * u) - a) / (b - a) end "position" from share)
select doc_id, source, size, "copy"::bigint "copy", "position"::double "position",
  (row_number() over (order by "position", doc_id, "copy") - 1)::bigint "rank" from timed
"""


@query("op7_training_order", _OP7_ORDER)
def op7_training_order(spark, sf_dir):
    from basketflow.llm import curriculum as cu
    return cu.training_order(cu.doc_sizes(_table(spark, sf_dir, "documents")), Stages(spark, "op7o"))


_OP8 = """
with recursive v as (
  select vec_id, embedding::double[] e, sqrt(list_sum([x * x for x in embedding::double[]])) n from embeddings
  where embedding is not null and len([1 for x in embedding if x is null or not isfinite(x)]) = 0),
unit as (select vec_id, e, n from v where n > 0),
link as (select a.vec_id a, b.vec_id b from unit a join unit b on a.vec_id <> b.vec_id and len(a.e) = len(b.e)
         where case when len(a.e) = len(b.e) then list_dot_product(a.e, b.e) / (a.n * b.n) end >= 0.9),
reach(v, r) as (select vec_id, vec_id from embeddings union select reach.v, link.b from reach join link on link.a = reach.r),
comp as (select v, min(r) c from reach group by v),
n as (select a, count(*) n from link group by a)
select vec_id, coalesce(n.n, 0)::bigint n_links, c::bigint component_id, vec_id = c kept
from embeddings left join n on n.a = vec_id join comp on comp.v = vec_id
"""


@query("op8_inverted_multi_index", _OP8)
def op8_inverted_multi_index(spark, sf_dir):
    from basketflow.llm import imi
    return imi.near_duplicates(_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), Stages(spark, "op8"))


@query("op9_byte_bpe")
def op9_byte_bpe(spark, sf_dir, vocab_path: str | None = None, pattern: str | None = None):
    import public_tokenizers

    from basketflow.llm import bpe
    ranks = bpe.read_vocab(vocab_path or public_tokenizers.path("byte_bpe_50k.tiktoken"))
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.encode(docs, ranks, pattern or public_tokenizers.PATTERN).drop("text")
    return bpe.decode(coded, ranks).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))


_OP10 = r"""
with l as (select doc_id, text, string_split(text, chr(10)) l from documents),
line as (select doc_id, unnest(range(1, len(l) + 1)) i, unnest(l) x from l),
worded as (select doc_id, i, lead(i) over (partition by doc_id order by i) j from line where regexp_matches(x, '[^\x20\x09-\x0D]')),
pair as (select doc_id, i, j, array_to_string(l[i : j], chr(10)) bytes from worded join l using (doc_id) where j is not null),
marked as (select *, first_value(doc_id) over f fd, first_value(j) over f fj from pair window f as (partition by bytes order by doc_id, i)),
gone as (select distinct doc_id, unnest(range(i, j + 1)) i from marked where doc_id <> fd or i > fj),
kept as (select line.doc_id, string_agg(x, chr(10) order by line.i) filter (gone.i is null) t, count(*) n, count(gone.i) r
         from line left join gone on gone.doc_id = line.doc_id and gone.i = line.i group by line.doc_id)
select doc_id, case when text is not null then coalesce(t, '') end as text, coalesce(n, 0)::bigint n_lines, coalesce(r, 0)::bigint n_removed
from documents left join kept using (doc_id)
"""


@query("op10_line_chunks", _OP10)
def op10_line_chunks(spark, sf_dir):
    from basketflow.llm import line_dedup as ld
    return ld.dedup(_table(spark, sf_dir, "documents").select("doc_id", "text"), Stages(spark, "op10"))


@query("op10_line_passages", _OP10)
def op10_line_passages(spark, sf_dir):
    from basketflow.llm import line_dedup as ld
    return ld.passages(_table(spark, sf_dir, "documents").select("doc_id", "text"), Stages(spark, "op10p"))


def _op11_sql() -> str:
    """Votes and spans in SQL: the templates' grams as text, no hashes; slack and need as in the operator."""
    from basketflow.llm import licenses as li
    rows = ",\n".join(f"({i}, '{' '.join(t.words)}', '{t.label}', {str(t.base).lower()}, {t.need}, {t.slack}, {t.gram})" for i, t in enumerate(li.templates()))
    return rf"""
with t(tid, phrase, label, base, need, slack, g) as (values {rows}),
tw as (select *, string_split(phrase, ' ') tw from t),
tg as (select tid, p tpos, array_to_string(tw[p + 1 : p + g], ' ') gram, g, slack from (select *, unnest(range(0, len(tw) - g + 1)) p from tw)),
d as (select row_number() over () r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w from documents),
word as (select r, w, unnest(range(0, len(w))) p from d),
dg as (select r, p, g, array_to_string(w[p + 1 : p + g], ' ') gram from word, (select distinct g from t) where p + g <= len(w)),
vote as (select r, tid, tpos, p, dg.g, unnest(range(-slack, slack + 1)) shift from dg join tg on dg.gram = tg.gram and dg.g = tg.g),
seen as (select r, tid, p - tpos + shift diagonal, shift, unnest(range(tpos, tpos + g)) word from vote),
span as (select r, tid, diagonal, count(distinct word) covered from seen group by all having bool_or(shift = 0)),
good as (select span.*, label, base, len(tw) n from span join tw using (tid) where covered >= need),
found as (select r, count(*) filter (base) n_base, min(diagonal) filter (base) first_word, max(diagonal) filter (base) last_word,
            string_agg(distinct label, ',' order by label) filter (base) base_labels, string_agg(distinct label, ',' order by label) labels,
            max(covered::double / n) score from good group by r)
select doc_id, len(w)::bigint n_words, coalesce(n_base, 0)::bigint n_base, first_word::bigint first_word, last_word::bigint last_word,
  coalesce(base_labels, '') base_labels, coalesce(labels, '') labels, coalesce(score, 0.0)::double score from d left join found using (r)
"""


@query("op11_license_votes", _op11_sql())
def op11_license_votes(spark, sf_dir):
    from basketflow.llm import licenses as li
    rows = li.scan(_table(spark, sf_dir, "documents").select("doc_id", "text"), Stages(spark, "op11"))
    base = F.filter("spans", lambda s: s["base"])
    starts = F.transform(base, lambda s: s["start"].cast("long"))
    names = lambda spans: F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")
    shares = F.transform("spans", lambda s: s["covered"].cast("double") / s["words"])
    return rows.select(F.col("_row.doc_id").alias("doc_id"), "n_words", F.size(base).cast("long").alias("n_base"),
                       F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"), names(base).alias("base_labels"),
                       names(F.col("spans")).alias("labels"), F.coalesce(F.array_max(shares), F.lit(0.0)).alias("score"))


def _op12_sql(k: int = 16, rounds: int = 3, dims: int = 64) -> str:
    """The rounds one after the other, with one row per vector and component."""
    ctes = [f"""v as materialized (select row_number() over () r, vec_id, [floor(64 * x::double)::bigint for x in embedding] x from embeddings
        where embedding is not null and len(embedding) = {dims} and len([1 for x in embedding if x is null or not isfinite(x)]) = 0)""",
            f"c0 as (select row_number() over (order by sha256('1:' || vec_id) nulls last, x) - 1 c, x from v qualify c < {k})",
            "vx as materialized (select r, unnest(range(1, len(x) + 1)) j, unnest(x) x from v)"]
    for i in range(rounds + 1):
        ctes.append(f"c{i}x as materialized (select c, unnest(range(1, len(x) + 1)) j, unnest(x) y from c{i})")
        ctes.append(f"""a{i} as materialized (select r, arg_min(c, d * {k} + c) c, min(d) d from (
            select r, c, sum((x - y) * (x - y)) d from vx join c{i}x using (j) group by r, c) group by r)""")
        if i < rounds:
            ctes.append(f"""s{i} as (select c, j, sum(x)::hugeint s, count(*)::hugeint n from a{i} join vx using (r) group by c, j),
            m{i} as (select c, list((s - ((s % n) + n) % n) // n order by j)::bigint[] x from s{i} group by c),
            c{i + 1} as materialized (select c{i}.c, coalesce(m{i}.x, c{i}.x) x from c{i} left join m{i} using (c))""")
    return ("with " + ",\n".join(ctes) + f""",
per as (select c, sum(d) own from a{rounds} group by c)
select vec_id, a{rounds}.c::int cluster, d::bigint distance, own::bigint cluster_inertia, (select sum(d) from a{rounds})::bigint inertia,
  sha256(array_to_string(c{rounds}.x, ',')) centroid_sha256
from v join a{rounds} using (r) join per on per.c = a{rounds}.c join c{rounds} on c{rounds}.c = a{rounds}.c""")


@query("op12_centroid_clusters", _op12_sql())
def op12_centroid_clusters(spark, sf_dir):
    from basketflow.llm import centroids as ce
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return ce.cluster(vectors, Stages(spark, "op12")).drop("centroid")


@query("op13_qd_whitening")
def op13_qd_whitening(spark, sf_dir):
    from basketflow.llm import whitening as wh
    rows = wh.whiten(_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), Stages(spark, "op13"))
    each = rows.select("vec_id", "n", "deviation", "explained", "identity_error", F.posexplode("whitened").alias("i", "whitened"))
    return each.select("vec_id", (F.col("i") + 1).alias("component"), "n", F.col("deviation").cast("long").alias("deviation"), "whitened",
                       F.get("explained", F.col("i")).alias("explained"), "identity_error")
