"""Registered queries of the corpus operators, each with SQL where SQL can say it."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopflow.llm import (
    bpe,
    conversations,
    exact_dedup,
    fingerprints,
    html_extract,
    lang_id,
    lexical,
    lm_score,
    mixing,
    near_dedup,
    quality,
    secrets,
    topk_search,
)
from shopflow.llm.common import bounded_batches, fold_is, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


@query(
    "op5_exact_dedup",
    r"""with n as (select doc_id, length(coalesce(text, '')) points, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) text_sha256 from documents),
    w as (select *, first_value(doc_id) over (partition by text_sha256 order by points desc, doc_id) keep_id, count(*) over (partition by text_sha256) group_size from n)
    select doc_id, keep_id, group_size, doc_id = keep_id kept, text_sha256 from w""",
)
def exact(spark, folder):
    groups = exact_dedup.exact_groups(table(spark, folder, "documents"))
    return groups.select(F.col("_id").alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256")


@query("op8_source_mixing")
def mixed(spark, folder):
    placed = mixing.mix(table(spark, folder, "documents"))
    return placed.withColumnsRenamed({"_id": "doc_id", "_source": "source"})


@query(
    "op9_topk_search",
    """with v as (select vec_id, [floor(256 * x::double)::bigint for x in embedding] w from embeddings
      where embedding is not null and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
    e as (select vec_id, unnest(w) x, generate_subscripts(w, 1) i from v),
    s as (select q.vec_id query_id, c.vec_id, sum(q.x * c.x)::bigint score from e q join e c on c.i = q.i and c.vec_id <> q.vec_id where q.vec_id % 50 = 0 group by 1, 2),
    r as (select query_id, (row_number() over (partition by query_id order by score desc, vec_id))::int as rank, vec_id, score from s)
    select * from r where rank <= 5""",
)
def top_five(spark, folder):
    bounded_batches(spark)
    return topk_search.top_k(table(spark, folder, "embeddings"))


def _span_sql() -> str:
    parts = []
    for order, rule in enumerate(secrets.BASE_RULES + secrets.MORE_RULES):
        pattern = rule.pattern.replace("'", "''")
        parts.append(
            f"""select doc_id, {order} place, '{rule.kind}' kind, len(part) >= {rule.least} good,
              sum(len(gap) + len(whole)) over (partition by doc_id order by i) ends, len(whole) size from (
              select doc_id, unnest(regexp_extract_all(text, '{pattern}')) whole, unnest(regexp_extract_all(text, '{pattern}', {rule.group})) part,
                unnest(string_split_regex(text, '{pattern}')[:len(regexp_extract_all(text, '{pattern}'))]) gap,
                generate_subscripts(regexp_extract_all(text, '{pattern}'), 1) i
              from texts where regexp_matches(text, '{pattern}'))"""
        )
    return " union all ".join(parts)


@query(
    "op10_secret_scan",
    f"""with texts as (select doc_id, coalesce(text, '') as text from documents),
    spans as (select doc_id, place, kind, (ends - size)::bigint starts, ends::bigint ends from ({_span_sql()}) where good),
    lines as (select doc_id, count(*) filter (kind = 'assign') a, count(*) filter (kind = 'access') k, count(*) filter (kind = 'hex') h,
      string_agg(kind || ':' || starts || ':' || ends, ',' order by starts, place) filter (place < 3) base,
      string_agg(kind || ':' || starts || ':' || ends, ',' order by starts, place) spans from spans group by 1)
    select t.doc_id, coalesce(a, 0) n_assign, coalesce(k, 0) n_access, coalesce(h, 0) n_hex, sha256(coalesce(base, '')) base_sha256, coalesce(spans, '') spans
    from texts t left join lines using (doc_id)""",
)
def secret_scan(spark, folder):
    return secrets.scan_report(table(spark, folder, "documents"))


def word_vocabulary() -> str:
    """Where the public word vocabulary lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query("op3_bpe_tree")
def encoded(spark, folder):
    return bpe.token_report(table(spark, folder, "documents"), word_vocabulary())


@query("op6_lm_automaton")
def scored(spark, folder):
    return lm_score.score(table(spark, folder, "documents"))


def language_model(docs: DataFrame):
    """Languages learned from the labelled texts outside the held-out fold."""
    return lang_id.learn(docs.filter(~fold_is(F.col("doc_id"), 4, 2)), "text", "lang")


@query("op7_language_spans")
def languages(spark, folder):
    docs = table(spark, folder, "documents")
    found = lang_id.label_languages(docs, language_model(docs))
    return found.select(
        F.col("_id").alias("doc_id"), fold_is(F.col("_id"), 4, 2).alias("held_out"), "lang_pred", "score", F.size("spans").alias("n_spans")
    )


@query("op4_near_dedup")
def near(spark, folder):
    classes = near_dedup.near_classes(table(spark, folder, "documents"))
    return classes.select(F.col("_id").alias("doc_id"), "class_id", "class_size", "n_links", "kept")


@query("op1_quality_mil")
def quality_scores(spark, folder):
    return quality.quality_report(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op2_html_trees")
def main_texts(spark, folder):
    pages = table(spark, folder, "pages")
    found = html_extract.extract(pages, html_extract.learn(pages))
    return found.withColumnsRenamed({"_id": "page_id", "_url": "url"})


# crc32 by its table, which SQL makes from the polynomial; K, R, D, I as moves between the states nothing, s, u and a.
@query(
    "op11_conversation_repair",
    r"""with recursive crc as (select list(v order by i) t from (select i, list_reduce(list_prepend(i::bigint, range(8)),
        lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) v from range(256) r(i))),
    base as (select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
        xor(list_reduce(list_prepend(4294967295, list_transform(string_split(coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '), ''), lambda x: ord(x)::bigint)),
          lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 h from conversations, crc),
    hurt as (select conv_id, turn, case when h = 4 then 'user' else role end as role,
        case h when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text, unnest(range(case when h = 3 then 2 else 1 end)) copy from base where h <> 0),
    placed as (select *, regexp_replace(text, '[\x20\x09-\x0D]', '', 'g') bare, row_number() over (partition by conv_id order by turn nulls first, role, text) pos from hurt),
    faulty as (select *, bare = '' blank, bare <> '' and row_number() over (partition by conv_id, role, text order by pos) > 1 copied,
        bare <> '' and row_number() over (partition by conv_id, role, text order by pos) = 1 and right(bare, 1) not in ('.', '!', '?') cut,
        left(role, 1) as ini, lag(left(role, 1)) over (partition by conv_id order by pos) prev from placed),
    pre(e, st, ins, cost, lines) as (values (0, 0, '', 0, []::varchar[]), (1, 1, '', 0, []), (2, 2, '', 0, []), (3, 3, '', 0, []),
      (0, 2, 'I', 5, ['user:']), (1, 2, 'I', 5, ['user:']), (2, 3, 'I', 5, ['assistant:']), (3, 2, 'I', 5, ['user:']),
      (0, 3, 'II', 10, ['user:', 'assistant:']), (1, 3, 'II', 10, ['user:', 'assistant:']), (2, 2, 'II', 10, ['assistant:', 'user:']), (3, 3, 'II', 10, ['user:', 'assistant:'])),
    moves(st, edit, ini, x, cost) as (values (0, 'D', '*', 0, 2), (1, 'D', '*', 1, 2), (2, 'D', '*', 2, 2), (3, 'D', '*', 3, 2),
      (0, 'R', '*', 2, 1), (1, 'R', '*', 2, 1), (2, 'R', '*', 3, 1), (3, 'R', '*', 2, 1), (0, 'K', 's', 1, 0), (0, 'K', 'u', 2, 0), (1, 'K', 'u', 2, 0), (3, 'K', 'u', 2, 0), (2, 'K', 'a', 3, 0)),
    ways(conv_id, pos, st, cost, audit, lines) as (select distinct conv_id, 0::bigint, 0, 0, '', []::varchar[] from placed
      union all
      select conv_id, pos, x, cost, audit, lines from (
        select w.conv_id, f.pos, m.x, w.cost + p.cost + m.cost + (case when f.cut and m.edit <> 'D' then 5 else 0 end) as cost, w.audit || p.ins || m.edit as audit,
          w.lines || p.lines || (case m.edit when 'D' then [] when 'K' then [f.role || ':' || f.text] else [(case m.x when 2 then 'user:' else 'assistant:' end) || f.text] end) as lines,
          row_number() over (partition by w.conv_id, m.x order by w.cost + p.cost + m.cost + (case when f.cut and m.edit <> 'D' then 5 else 0 end), w.audit || p.ins || m.edit) n
        from ways w join faulty f on f.conv_id is not distinct from w.conv_id and f.pos = w.pos + 1 join pre p on p.e = w.st
          join moves m on m.st = p.st and m.ini in ('*', f.ini) and (m.edit = 'D' or not (f.blank or f.copied))) where n = 1),
    closing(st, ins, cost, lines) as (values (0, '', 0, []::varchar[]), (3, '', 0, []), (2, 'I', 5, ['assistant:']), (1, 'II', 10, ['user:', 'assistant:'])),
    ended as (select w.conv_id, w.cost + c.cost as cost, w.audit || c.ins as audit, w.lines || c.lines as lines,
        row_number() over (partition by w.conv_id order by w.cost + c.cost, w.audit || c.ins) n
      from ways w join (select conv_id, max(pos) pos from faulty group by 1) l on l.conv_id is not distinct from w.conv_id and l.pos = w.pos join closing c on c.st = w.st),
    counts as (select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) gaps, count(*) filter (blank) blank, count(*) filter (copied) duplicate,
        count(*) filter (cut) truncated, count(*) filter (pos > 1 and prev || ini not in ('su', 'ua', 'au')) illegal from faulty group by 1)
    select i.conv_id, coalesce(gaps, 0)::bigint gaps, coalesce(blank, 0)::bigint blank, coalesce(duplicate, 0)::bigint duplicate, coalesce(truncated, 0)::bigint truncated,
      coalesce(illegal, 0)::bigint illegal, coalesce(e.cost, 0)::bigint as cost, coalesce(e.audit, '') as audit, sha256(coalesce(array_to_string(e.lines, chr(10)), '')) repaired_sha256
    from (select distinct conv_id from conversations) i left join counts c on c.conv_id is not distinct from i.conv_id
      left join ended e on e.conv_id is not distinct from i.conv_id and e.n = 1""",
)
def repaired(spark, folder):
    return conversations.repair_report(table(spark, folder, "conversations"))


@query("op12_fingerprints")
def fingerprinted(spark, folder):
    return fingerprints.fingerprint_report(table(spark, folder, "documents"))


@query(
    "op13_lexical_search",
    r"""with d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') terms from documents),
    s as (select count(*) filter (len(terms) > 0)::bigint docs, sum(len(terms))::bigint words from d),
    p as (select doc_id, len(terms)::bigint n, term, count(*)::bigint tf from (select doc_id, terms, unnest(terms) term from d) group by 1, 2, 3),
    w as (select term, floor(1000 * ln((2 * docs + 2)::double / (2 * count(*) + 1)::double))::bigint w from p, s group by term, docs),
    i as (select item_id, term, count(*) times from (select item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) term from benchmark) group by 1, 2),
    r as (select item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + ((25 * n * docs) // words)))))::bigint score
      from i join p using (term) join w using (term), s group by 1, 2),
    k as (select item_id, (row_number() over (partition by item_id order by score desc, doc_id))::int as rank, doc_id, score from r where score > 0)
    select * from k where rank <= 20""",
)
def ranked(spark, folder):
    return lexical.ranked_search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
