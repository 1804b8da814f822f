"""The registered queries of the llm operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@register("op10_simhash")
def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprint and near-duplicate component of every document."""
    from eventide.llm import simhash
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


@register("op8_langid")
def op8_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by the word-level field."""
    from eventide.llm import langid
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = langid.predict(docs, langid.fit(docs), keep=["doc_id"])
    return found.select("doc_id", langid.held_out(F.col("doc_id"), 4, 2).alias("held_out"), "lang_pred", "score")


@register("op2_quality")
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    from eventide.llm import langid, quality
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")), keep=["doc_id"])
    return found.select("doc_id", langid.held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score",
                        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


@register("op7_byte_bpe")
def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count, id digest and decoded digest of every document."""
    import public_tokenizers as P

    from eventide.llm import bpe
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.tokenize(docs, P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN, keep=["doc_id"])


_OP6 = r"""
WITH docs AS (
  SELECT doc_id, source, coalesce('s' || source, 'n') AS k,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5('mix:' || coalesce(doc_id::VARCHAR, '')) AS m
  FROM documents),
per AS (
  SELECT k, source, sum(size)::BIGINT AS s,
         CASE (row_number() OVER (ORDER BY source IS NULL, source COLLATE "C") - 1) % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0 ELSE 2.0 END AS w
  FROM docs GROUP BY k, source),
lvl AS (
  SELECT *, (sum(s) OVER ()::DOUBLE * 1.5 - (sum(s) OVER upto::DOUBLE * 2 - s * 2.0::DOUBLE)) / sum(w) OVER onward AS level,
         row_number() OVER (ORDER BY s * 2.0::DOUBLE / w, source IS NULL, source) AS pos
  FROM per
  WINDOW upto AS (ORDER BY s * 2.0::DOUBLE / w, source IS NULL, source ROWS UNBOUNDED PRECEDING),
         onward AS (ORDER BY s * 2.0::DOUBLE / w, source IS NULL, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
free AS (SELECT min_by(level, pos) AS level FROM lvl WHERE s * 2.0::DOUBLE / w > level),
tgt AS (
  SELECT k, s, coalesce(least(s * 2.0::DOUBLE, (SELECT level FROM free) * w), s * 2.0::DOUBLE) AS target,
         (('0x' || substr(md5('mix/' || k), 1, 4))::INTEGER)::DOUBLE / 65536 AS u
  FROM lvl),
ranked AS (
  SELECT docs.*, row_number() OVER (PARTITION BY k ORDER BY lpad(length(bin(size))::VARCHAR, 2, '0') || substr(bin(size), 1, 5),
                                    substr(m, 1, 2), size, m, doc_id) AS r
  FROM docs),
rated AS (
  SELECT ranked.*, s, target, u, CASE WHEN s > 0 THEN target / s ELSE 0.0::DOUBLE END AS c FROM ranked JOIN tgt USING (k))
SELECT doc_id, size, s AS source_size, target,
       least(floor(c * r + u) - floor(c * (r - 1) + u), ceil(c))::BIGINT * size AS taken
FROM rated
"""


@register("op6_mixing", _OP6)
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that the mix of sources takes."""
    from eventide.llm import mixing
    from eventide.plans.lineage import materialize
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", mixing.word_count(F.col("text")).alias("size"))
    mixed = mixing.mix(materialize(docs, "mix-sizes"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


@register("op4_imatch")
def op4_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I-Match fingerprint of every document and of its edited text."""
    from eventide.llm import imatch
    return imatch.compare(table(spark, sf_dir, "documents").select("doc_id", "text"))


@register("op5_ann")
def op5_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five nearest vectors of every fiftieth one."""
    from eventide.llm import ann
    return ann.search(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def _sql_text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _sql_canonical(t: str) -> str:
    """The canonical form of licenses.with_canonical in DuckDB SQL."""
    from eventide.llm import licenses as L
    whole = removed = f"lower(coalesce({t}, ''))"
    for pattern, groups in L._REMOVED:
        kept = " ".join(["", *[f"\\{i}" for i in range(1, groups + 1)]]) or " "
        removed = f"regexp_replace({removed}, {_sql_text('(?m)' + pattern)}, {_sql_text(kept)}, 'g')"
    marked = " OR ".join(f"contains({whole}, '{x}')" for x in ("copyright", "(c)", "©", "all rights reserved"))
    words = "'[\\p{L}\\p{N}]'"
    t = f"CASE WHEN {marked} THEN CASE WHEN regexp_matches({removed}, {words}) THEN {removed} ELSE {whole} END ELSE {whole} END"
    t = f"regexp_replace({t}, {_sql_text(L._OTHER)}, ' ', 'g')"
    t = f"trim({t})"
    for a, b in L.EQUIVALENT:
        t = f"regexp_replace({t}, '\\b{a}\\b', '{b}', 'g')"
    return t


def _op1_sql() -> str:
    from eventide.llm import licenses as L
    values = lambda rows: ", ".join(f"({_sql_text(a)}, {_sql_text(b)})" for a, b in rows)
    known = "SELECT sha256({0}) AS digest, min(license) AS license FROM (VALUES {1}) v(license, t) GROUP BY 1"
    return f"""
WITH whole AS ({known.format(_sql_canonical('t'), values(L.LICENSES))}),
line AS ({known.format(_sql_canonical('t'), values(L.NOTICES))}),
docs AS (SELECT doc_id, text, {_sql_canonical('text')} AS form FROM documents),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS t FROM documents),
hits AS (SELECT doc_id, string_agg(DISTINCT license, ',' ORDER BY license) AS notices
         FROM lines JOIN line ON sha256({_sql_canonical('t')}) = digest GROUP BY doc_id)
SELECT docs.doc_id, sha256(form) AS digest, license, notices,
       CASE WHEN form = '' THEN 0 ELSE length(form) - length(replace(form, ' ', '')) + 1 END::BIGINT AS n_words
FROM docs LEFT JOIN whole ON sha256(form) = digest LEFT JOIN hits USING (doc_id)
"""


@register("op1_licenses", _op1_sql())
def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence of every document's whole text, and the licence notices among its lines."""
    from eventide.llm import licenses
    return licenses.scan(table(spark, sf_dir, "documents"))


def _op3_sql(rare: int = 5) -> str:
    from eventide.llm import urls as U
    rules = sorted(U.RULES, key=lambda r: (-len(r[1] + r[2]), -len(r[1])))
    when = lambda of: " ".join(
        f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{of(v, h, p)}'" for v, h, p in rules)
    seg = ("CASE WHEN regexp_matches(s, '^[0-9]+$') THEN '{n}' WHEN regexp_matches(s, '^[0-9a-fA-F-]{16,}$') THEN '{hex}' "
           "ELSE regexp_replace(s, '[0-9]+', '{n}', 'g') END")
    unlike = ("coalesce({l} > 0 AND fl - l > 0 AND ({b} / {l} - (fb - b) / (fl - l)) * ({b} / {l} - (fb - b) / (fl - l)) "
              "> 3.8416::DOUBLE * (({b} + (fb - b)) / ({l} + (fl - l))) * (1 - ({b} + (fb - b)) / ({l} + (fl - l))) "
              "* (1 / {l} + 1 / (fl - l)), false)")
    return f"""
WITH RECURSIVE hp AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '{U._URL}', 1), ''), '{U.UPPER}', '{U.LOWER}') AS host,
         coalesce(regexp_extract(url, '{U._URL}', 2), '') AS path FROM pages),
rows0 AS (
  SELECT *, CASE {when(lambda v, h, p: h + p)} END AS rule, CASE {when(lambda v, h, p: v)} END AS rv,
         list_filter(string_split(path, '/'), lambda s: s <> '') AS parts FROM hp),
r AS (SELECT *, array_to_string(list_transform(parts, lambda s: {seg}), '/') AS t FROM rows0),
seen AS (SELECT host, t, count(*) AS n, count(rule) AS l, count(*) FILTER (rv = 'block') AS b FROM r GROUP BY ALL),
paths AS (SELECT 'h:' || host AS scope, * EXCLUDE (host) FROM seen
          UNION ALL SELECT 'all', t, sum(n), sum(l), sum(b) FROM seen GROUP BY t),
anywhere AS (SELECT i - 1 AS d, string_split(t, '/')[i] AS seg, sum(l)::DOUBLE AS sl, sum(b)::DOUBLE AS sb
             FROM (SELECT *, unnest(range(1, len(string_split(t, '/')) + 1)) AS i FROM seen WHERE t <> '') GROUP BY ALL),
tree AS (
  SELECT scope, t, n, l, b, string_split(t, '/') AS segs, 0::BIGINT AS d, '' AS prefix FROM paths WHERE t <> ''
  UNION ALL (
    WITH here AS (SELECT *, segs[d + 1] AS seg FROM tree WHERE len(segs) > d),
    nodes AS (SELECT scope, prefix, d, seg, sum(n) AS n, sum(l)::DOUBLE AS l, sum(b)::DOUBLE AS b FROM here GROUP BY ALL),
    family AS (SELECT scope, prefix, sum(l) AS fl, sum(b) AS fb, count(*) AS kids FROM nodes GROUP BY ALL),
    node AS (SELECT scope, prefix, seg, CASE WHEN kids = 1 THEN seg WHEN n < {rare} THEN CASE WHEN {unlike.format(l='sl', b='sb')} THEN seg ELSE '*' END
               WHEN l >= {rare} AND fl - l >= {rare} AND NOT ({unlike.format(l='l', b='b')}) THEN '*' ELSE seg END AS g
             FROM nodes JOIN family USING (scope, prefix) JOIN anywhere USING (d, seg))
    SELECT scope, t, n, l, b, segs, d + 1, prefix || CASE WHEN d > 0 THEN '/' ELSE '' END || g FROM here JOIN node USING (scope, prefix, seg))),
named AS (SELECT scope, t, n, l, b, prefix AS template FROM tree WHERE len(segs) = d
          UNION ALL SELECT scope, t, n, l, b, '' FROM paths WHERE t = ''),
pur AS (SELECT scope, template, sum(l)::DOUBLE AS tl, sum(b)::DOUBLE AS tb FROM named GROUP BY ALL),
base AS (SELECT CASE WHEN sum(l) > 0 THEN sum(b)::DOUBLE / sum(l)::DOUBLE ELSE 0.0::DOUBLE END AS p FROM seen),
overall AS (SELECT t, (tb + 2.0::DOUBLE * p) / (tl + 2.0::DOUBLE) AS pg FROM named JOIN pur USING (scope, template), base WHERE scope = 'all'),
judged AS (SELECT substr(scope, 3) AS host, t, template, (tb + 2.0::DOUBLE * pg) / (tl + 2.0::DOUBLE) AS blocked_share
           FROM named JOIN pur USING (scope, template) JOIN overall USING (t) WHERE scope <> 'all')
SELECT page_id, host, path, rule, coalesce(rv, CASE WHEN blocked_share > 0.5 THEN 'block' ELSE 'allow' END) AS verdict,
       template, blocked_share
FROM r JOIN judged USING (host, t)
"""


@register("op3_urls", _op3_sql())
def op3_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url."""
    from eventide.llm import urls
    return urls.judge(table(spark, sf_dir, "pages").select("page_id", "url"))


_OP9 = """
WITH t AS (
  SELECT conv_id, turn, coalesce(role, 'unknown') AS role, replace(coalesce(text, ''), '<|', '< |') AS said FROM conversations),
n AS (
  SELECT *, (row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, said[1:32], sha256(said)) - 1) AS place FROM t),
p AS (SELECT DISTINCT conv_id, role AS participant FROM t WHERE role <> 'system'),
s AS (
  SELECT n.conv_id, (n.place // 256)::BIGINT AS part, participant, place, role, role = participant AS own,
         '<|im_start|>' || CASE WHEN role = 'system' THEN 'system' WHEN role = participant THEN 'assistant'
                                ELSE 'user name=' || role END || chr(10) AS head, said || '<|im_end|>' AS body
  FROM p JOIN n ON p.conv_id IS NOT DISTINCT FROM n.conv_id),
o AS (
  SELECT *, (sum(length(head) + length(body) + 1) OVER w - length(body) - 1)::BIGINT AS begin FROM s
  WINDOW w AS (PARTITION BY conv_id, part, participant ORDER BY place ROWS UNBOUNDED PRECEDING))
SELECT conv_id, part, participant, count(*) AS n_turns, string_agg(head || body || chr(10), '' ORDER BY place) AS text,
       coalesce(string_agg(CASE WHEN own THEN begin || '-' || (begin + length(body)) END, ',' ORDER BY begin), '') AS loss_spans,
       sum(CASE WHEN own THEN length(body) ELSE 0 END)::BIGINT AS loss_chars
FROM o GROUP BY conv_id, part, participant
"""


@register("op9_chat", _OP9)
def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every participant's perspective of every conversation."""
    from eventide.llm import chat
    return chat.dialogues(table(spark, sf_dir, "conversations"))


_TERMS_OF = r"regexp_extract_all(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{1}')"
_OP13 = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, {_TERMS_OF.format("text", r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")} AS ts FROM documents),
i AS (SELECT item_id, row_number() OVER () AS q, {_TERMS_OF.format("text", r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")} AS ts FROM benchmark),
total AS (SELECT count(*) FILTER (len(ts) > 0) AS docs, sum(len(ts))::HUGEINT AS words FROM d),
asked AS (SELECT q, term, count(*) AS times FROM (SELECT q, unnest(ts) AS term FROM i) GROUP BY ALL),
held AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(ts) AS term FROM d)
         WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
weighed AS (SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
            FROM held, total GROUP BY term),
norm AS (SELECT r, doc_id, (75 + (25 * len(ts)::HUGEINT * docs) // words)::BIGINT AS m FROM d, total WHERE len(ts) > 0),
scored AS (SELECT q, r, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
           FROM held JOIN norm USING (r) JOIN asked USING (term) JOIN weighed USING (term) GROUP BY q, r),
ranked AS (SELECT q, doc_id, score, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS rank
           FROM scored JOIN norm USING (r) WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked JOIN i USING (q) WHERE rank <= 20
"""


@register("op13_lexical", _OP13)
def op13_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twenty best documents of every benchmark item."""
    from eventide.llm import lexical
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_OP11 = f"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  {_TERMS_OF.format("coalesce(text, '')", r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")} AS ts FROM documents),
o AS (SELECT r, lang, source, term, count(*) AS n FROM (SELECT r, lang, source, unnest(ts) AS term FROM d) GROUP BY ALL),
kept AS (SELECT lang, term, sum(n) AS n FROM o GROUP BY ALL HAVING count(*) >= 10),
g AS (SELECT DISTINCT lang, source FROM d),
per AS (SELECT lang, source, term, sum(n) AS n FROM o GROUP BY ALL),
c AS (SELECT lang, source, term, coalesce(per.n, 0) AS n FROM g JOIN kept USING (lang) LEFT JOIN per USING (lang, source, term)),
total AS (SELECT lang, source, sum(n) AS words, count(*) AS v FROM c GROUP BY ALL),
p AS (SELECT lang, source, term, n, 1 + (1000000000::HUGEINT * (n + 2)) // (words + 2 * v) AS p FROM c JOIN total USING (lang, source)),
of_lang AS (SELECT lang, sum(n) AS words, count(*) AS v FROM kept GROUP BY ALL),
q AS (SELECT lang, term, 1 + (1000000000::HUGEINT * (n + 2)) // (words + 2 * v) AS q FROM kept JOIN of_lang USING (lang)),
both_ways AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
              FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN both_ways w ON w.lang = a.lang AND w.source = a.source AND w.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (((p - q) * (p - q)) // (p + q))::BIGINT FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM parts)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 10
"""


@register("op11_divergence", _OP11)
def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergence of every source of a language from every other, and its most overused terms."""
    from eventide.llm import divergence
    return divergence.audit(table(spark, sf_dir, "documents"))


@register("op12_pii")
def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: base spans and those that the field adds."""
    from eventide.llm import pii
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.scan(docs, pii.fit(docs), keep=["doc_id"])
