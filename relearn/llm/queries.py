"""Registered queries of the operators and their SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relearn.functions.hashrand import hash_index, hash_uniform
from relearn.llm import licences, lm, merkle, pieces, secret_ledger, toxicity, url_filters, whitening
from relearn.llm.common import documents, fold
from relearn.llm.decontaminate import decontaminate
from relearn.llm.language import dictionaries, identify
from relearn.llm.near_dedup import near_duplicates
from relearn.llm.quality import quality_rules
from relearn.llm.substring_dedup import remove_repeats
from relearn.session import checkpoint_path
from relearn.sources.tables import read_table

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(fn: Callable[[SparkSession, str], DataFrame]):
    REGISTRY[fn.__name__] = fn
    return fn


@register
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    built, order = dictionaries(docs.where(fold("doc_id", 4) != 2).select("doc_id", "text", "lang"))
    out = identify(docs, built, order)
    return out.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score", "rejected")


@register
def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir), shingle=4, percent=80).select("doc_id", "n_shingles", "component_id", "kept")


@register
def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(documents(spark, sf_dir), window=50)
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


@register
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(documents(spark, sf_dir)).drop("text_key")


@register
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "toxic")
    learnt = fold("doc_id", 3) != 1
    model = toxicity.fit(toxicity.sample(docs.where(learnt), labels.where(learnt)))
    out = toxicity.score(docs, model)
    return out.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "score", "predicted")


@register
def op6_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = pieces.load()
    docs = documents(spark, sf_dir).withColumn("chars", F.coalesce(F.col("text"), F.lit("")))
    out = pieces.decode(pieces.encode(docs, vocabulary, keep=("doc_id", "chars")), vocabulary)
    return out.select("doc_id", "n_pieces", "n_byte_pieces", "ids", (F.col("decoded") == F.col("chars")).alias("restored"))


@register
def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate(documents(spark, sf_dir), read_table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", (F.size("items") > 0).alias("leaked"), "items", "share")


@register
def op5_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    out = lm.score(docs, docs.where(fold("doc_id", 5) != 1))
    return out.select("doc_id", (fold("doc_id", 5) == 1).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@register
def op8_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(documents(spark, sf_dir))


@register
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"))


@register
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(documents(spark, sf_dir))


@register
def op13_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as one version of a path, against a new ledger."""
    ledger = checkpoint_path(spark, f"secrets-{uuid.uuid4().hex}")
    out = secret_ledger.scan_history(documents(spark, sf_dir), ledger, ("doc_id",))
    found, base = F.col("findings"), [r.kind for r in secret_ledger.BASE]

    def joined(spans):
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    def of(*kinds):
        return F.filter(found, lambda x: x["kind"].isin(*kinds))
    counts = [F.size(of(k)).cast("long").alias(f"n_{k}") for k in base]
    own = joined(of(*base))
    return out.select("doc_id", *counts, F.sha2(own.cast("binary"), 256).alias("base_sha256"), joined(found).alias("spans"))


MONTH, LISTED, AGAIN, PREFIXED = 30 * 1440, 0.3, 0.5, 0.1


@register
def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a capture of a time given by a hash of its id, against a list derived from the pages' hosts and
    first path segments: some are added, removed and added again at hashed times.  Times are minutes of January 2024."""
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    captures = pages.withColumn("fetched_at", hash_index("fetch", MONTH, F.col("page_id"), method="md5"))
    hosts = pages.select(url_filters.host(F.col("url")).alias("host")).where("host <> ''").distinct()
    entry, add = F.concat(F.lit("domain:"), "host"), hash_index("add", 20 * 1440, F.col("host"), method="md5")
    gone = add + 1 + hash_index("remove", 10 * 1440, F.col("host"), method="md5")
    listed = hosts.where(hash_uniform("list", "host", method="md5") < LISTED)
    lines = [listed.select(entry.alias("entry"), add.alias("at"), F.lit("add").alias("action")),
             listed.select(entry.alias("entry"), gone.alias("at"), F.lit("remove").alias("action")),
             listed.where(hash_uniform("again", "host", method="md5") < AGAIN)
             .select(entry.alias("entry"), (add + 15 * 1440).alias("at"), F.lit("add").alias("action"))]
    paths = pages.select(F.concat(url_filters.host(F.col("url")), F.lit("/"), F.get(url_filters.segments(F.col("url")), F.lit(0))).alias("p")).where(
        "p is not null and p not like '/%'").distinct()
    lines.append(paths.where(hash_uniform("prefix", "p", method="md5") < PREFIXED).select(
        F.concat(F.lit("prefix:"), "p").alias("entry"), hash_index("since", MONTH, F.col("p"), method="md5").alias("at"), F.lit("add").alias("action")))
    log = lines[0].unionByName(lines[1]).unionByName(lines[2]).unionByName(lines[3])
    out = url_filters.filter_urls(captures, log)
    return out.select("page_id", "fetched_at", "blocked", F.size("entries").cast("long").alias("n_entries"), F.array_join("entries", ",").alias("entries"))


def _u(seed: str, key: str) -> str:
    return f"(CAST(('0x' || substr(md5(concat_ws('|', '{seed}', coalesce(CAST({key} AS VARCHAR), chr(1)))), 1, 8)) AS BIGINT) / 4294967296.0)"


def _index(seed: str, n: int, key: str) -> str:
    return (f"CAST(CAST(('0x' || substr(md5(concat_ws('|', '{seed}', coalesce(CAST({key} AS VARCHAR), chr(1)))), 1, 15)) AS BIGINT)::HUGEINT"
            f" * {n} // 1152921504606846976 AS BIGINT)")


ORACLE["op3_url_filters"] = f"""
WITH p AS (SELECT page_id, url, {_index('fetch', MONTH, 'page_id')} AS fetched_at,
                  rtrim(lower(regexp_extract(url, '{url_filters.HOST}', 1)), '.') AS host,
                  list_filter(string_split(regexp_extract(url, '{url_filters.PATH}', 1), '/'), lambda x: x <> '') AS seg FROM pages),
     h AS (SELECT DISTINCT host, {_index('add', 20 * 1440, 'host')} AS added FROM p WHERE host <> '' AND {_u('list', 'host')} < {LISTED}),
     d AS (SELECT DISTINCT host || '/' || seg[1] AS k FROM p WHERE host <> '' AND len(seg) > 0),
     log AS (SELECT 'domain:' || host AS entry, added AS t, true AS is_on FROM h
             UNION ALL SELECT 'domain:' || host, added + 1 + {_index('remove', 10 * 1440, 'host')}, false FROM h
             UNION ALL SELECT 'domain:' || host, added + 15 * 1440, true FROM h WHERE {_u('again', 'host')} < {AGAIN}
             UNION ALL SELECT 'prefix:' || k, {_index('since', MONTH, 'k')}, true FROM d WHERE {_u('prefix', 'k')} < {PREFIXED}),
     state AS (SELECT entry, t, bool_or(is_on) AS is_on FROM log GROUP BY entry, t),
     keys AS (SELECT page_id, fetched_at, 'domain:' || array_to_string(string_split(host, '.')[i:], '.') AS entry
              FROM (SELECT *, unnest(range(1, len(string_split(host, '.')) + 1)) AS i FROM p WHERE host <> '')
              UNION ALL SELECT page_id, fetched_at, 'prefix:' || host || '/' || array_to_string(seg[1:i], '/')
              FROM (SELECT *, unnest(range(1, len(seg) + 1)) AS i FROM p WHERE host <> '')),
     active AS (SELECT k.page_id, k.entry FROM keys k ASOF JOIN state s ON k.entry = s.entry AND k.fetched_at >= s.t WHERE s.is_on)
SELECT p.page_id, p.fetched_at, count(a.entry) > 0 AS blocked, count(DISTINCT a.entry) AS n_entries,
       coalesce(string_agg(DISTINCT a.entry, ',' ORDER BY a.entry), '') AS entries
FROM p LEFT JOIN active a ON p.page_id = a.page_id GROUP BY p.page_id, p.fetched_at"""


def _rule_spans(rule: secret_ledger.Rule, rank: int) -> str:
    """Start and end (code points) of each match that counts, from the lengths of matches and of the text between them."""
    p, g = rule.pattern.replace("'", "''"), f", {rule.group}" if rule.group else ""
    return f"""
SELECT doc_id, '{rule.kind}' AS kind, {rank} AS rank, upto - length(m[k]) AS a, upto AS b
FROM (SELECT doc_id, m, g, k, CAST(list_sum(list_transform(s[1:k], lambda x: length(x))) + list_sum(list_transform(m[1:k], lambda x: length(x))) AS BIGINT) AS upto
      FROM (SELECT doc_id, m, g, s, unnest(range(1, len(m) + 1)) AS k
            FROM (SELECT doc_id, regexp_extract_all(t, '{p}') AS m, regexp_extract_all(t, '{p}'{g}) AS g, regexp_split_to_array(t, '{p}') AS s FROM d) WHERE len(m) > 0))
WHERE length(g[k]) >= {rule.least}"""


_JOINED = "coalesce(string_agg({}, ',' ORDER BY a, rank){}, '')"
_SPAN = "kind || ':' || a || ':' || b"
ORACLE["op13_secret_ledger"] = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
     f AS ({' UNION ALL '.join(_rule_spans(r, i) for i, r in enumerate(secret_ledger.RULES))})
SELECT d.doc_id, {', '.join(f"count(*) FILTER (WHERE kind = '{r.kind}') AS n_{r.kind}" for r in secret_ledger.BASE)},
       sha256({_JOINED.format(_SPAN, f" FILTER (WHERE rank < {len(secret_ledger.BASE)})")}) AS base_sha256,
       {_JOINED.format(_SPAN, " FILTER (WHERE kind IS NOT NULL)")} AS spans
FROM d LEFT JOIN f USING (doc_id) GROUP BY d.doc_id"""

_CRC = ("xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)),"
        " lambda crc, c: list_reduce([xor(crc, c), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)")


def _leaf(text: str) -> str:
    parts = [f"coalesce(strlen(CAST({v} AS VARCHAR)) || ':' || {v}, '-')" for v in ("doc_id", "source", "lang", "n_chars", text)]
    return f"sha256({' || '.join(parts)})"


ORACLE["op12_merkle_manifest"] = f"""
WITH RECURSIVE l AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS pos, {_leaf('text')} AS leaf,
            CASE WHEN {_CRC} % 5 = 0 THEN {_leaf(f"translate(text, '{merkle.CAPITALS}', '{merkle.SMALL}')")} ELSE {_leaf('text')} END AS bad FROM documents),
     built AS (SELECT source, 0 AS level, pos, leaf AS h FROM l
               UNION ALL
               SELECT source, level + 1, pos // 16, sha256(string_agg(h, '' ORDER BY pos))
               FROM (SELECT *, count(*) OVER (PARTITION BY source) AS n FROM built) WHERE n > 1 GROUP BY source, level, pos // 16),
     subs AS (SELECT source, h, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place
              FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY level DESC) AS r FROM built) WHERE r = 1),
     tops AS (SELECT 0 AS level, place AS pos, h FROM subs
              UNION ALL
              SELECT level + 1, pos // 16, sha256(string_agg(h, '' ORDER BY pos))
              FROM (SELECT *, count(*) OVER () AS n FROM tops) WHERE n > 1 GROUP BY level, pos // 16),
     nodes AS (SELECT 0 AS stage, source, level, pos, h FROM built UNION ALL SELECT 1, NULL, level, pos, h FROM tops),
     kin AS (SELECT stage, source, level, pos // 16 AS up, list(h ORDER BY pos) AS hs FROM nodes GROUP BY stage, source, level, pos // 16),
     most AS (SELECT source, max(level) AS height FROM built GROUP BY source),
     climb AS (SELECT doc_id, source, 0 AS stage, 0 AS level, pos, bad AS h, '' AS proof FROM l
               UNION ALL
               SELECT * FROM (
                 SELECT c.doc_id, c.source, CASE WHEN done THEN 1 ELSE c.stage END, CASE WHEN done THEN 0 ELSE c.level + 1 END,
                        CASE WHEN done THEN s.place ELSE c.pos // 16 END,
                        CASE WHEN done THEN c.h ELSE sha256(array_to_string(k.hs[1:c.pos % 16], '') || c.h || array_to_string(k.hs[c.pos % 16 + 2:], '')) END,
                        CASE WHEN done THEN c.proof ELSE c.proof || array_to_string(k.hs[1:c.pos % 16], '') || array_to_string(k.hs[c.pos % 16 + 2:], '') END
                 FROM (SELECT c.*, c.stage = 0 AND c.level = m.height AS done FROM climb c JOIN most m ON c.source IS NOT DISTINCT FROM m.source
                       WHERE c.stage = 0 OR c.level < (SELECT max(level) FROM tops)) c
                 JOIN subs s ON s.source IS NOT DISTINCT FROM c.source
                 LEFT JOIN kin k ON k.stage = c.stage AND k.level = c.level AND k.up = c.pos // 16
                                    AND (c.stage = 1 OR k.source IS NOT DISTINCT FROM c.source)))
SELECT l.doc_id, l.leaf, s.h AS subroot, r.h AS root, sha256(c.proof) AS proof_sha256, c.h AS folded_root, c.h = r.h AS verified
FROM climb c JOIN l USING (doc_id) JOIN subs s ON s.source IS NOT DISTINCT FROM l.source
JOIN (SELECT h FROM tops WHERE level = (SELECT max(level) FROM tops)) r ON true
WHERE c.stage = 1 AND c.level = (SELECT max(level) FROM tops)"""

_WORDS = "regexp_extract_all({}, '[^\\x20\\x09-\\x0D]+')"
_LOWER = f"translate(coalesce(text, ''), '{merkle.CAPITALS}', '{merkle.SMALL}')"

ORACLE["op2_near_dedup"] = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format(_LOWER)} AS ws FROM documents),
     s AS (SELECT DISTINCT doc_id, hash AS h FROM (
             SELECT doc_id, md5(array_to_string(ws[i:i + 3], ' ')) AS hash FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 1) + 1)) AS i FROM w WHERE len(ws) > 0))),
     n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
     shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
     links AS (SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)),
     both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
     reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN both_ways l ON r.b = l.a),
     c AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM c LEFT JOIN n USING (doc_id)"""

ORACLE["op4_substring_dedup"] = f"""
WITH w AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS ws FROM documents),
     p AS (SELECT doc_id, i, ws[i] AS word, CASE WHEN i + 49 <= len(ws) THEN md5(array_to_string(ws[i:i + 49], ' ')) END AS h
           FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM w)),
     hit AS (SELECT doc_id, i, word, h IS NOT NULL AND min(doc_id) OVER (PARTITION BY h) < doc_id AS starts FROM p),
     gone AS (SELECT doc_id, i, word, bool_or(starts) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS removed FROM hit)
SELECT w.doc_id, count(i) AS n_words, count(i) FILTER (WHERE removed) AS n_removed,
       sha256(coalesce(string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT removed), '')) AS kept_sha256
FROM w LEFT JOIN gone USING (doc_id) GROUP BY w.doc_id"""
