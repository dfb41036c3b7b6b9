"""The registered queries of these operators, and the SQL that some can be checked with."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from auditlake.llm import conversation_repair, exact_dedup, lattice_lm, mixing, multi_index, ngram_join, packing, quality, ranked_search, sharding, slack_packing, toxicity, url_rules
from auditlake.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def held_out_by(ident: Column, folds: int, fold: int) -> Column:
    """Rows whose crc32 of the id as text leaves ``fold``; a null id counts as empty text."""
    return F.crc32(F.coalesce(ident.cast("string"), F.lit("")).cast("binary")) % folds == fold


@query(
    r"""
    WITH t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS x
               FROM documents)
    SELECT doc_id, max(doc_id) OVER (PARTITION BY x) AS keep_id, count(*) OVER (PARTITION BY x) AS group_size,
           row_number() OVER (PARTITION BY x ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(x) AS text_sha256
    FROM t
    """
)
def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return exact_dedup.mark_copies(docs, "doc_id", "text", keep=["doc_id"])


@query(
    r"""
    WITH RECURSIVE keys AS (
        SELECT doc_id, md5(coalesce(doc_id::VARCHAR, chr(0) || 'null')) AS digest FROM documents),
    jump AS (
        SELECT doc_id, digest, n, ('0x' || substr(digest, 1, 16))::UBIGINT::UHUGEINT AS key,
               -1::BIGINT AS pos, 0::BIGINT AS target
        FROM keys, (VALUES (16), (17)) v(n)
        UNION ALL
        SELECT doc_id, digest, n, next, target,
               floor((target + 1) * (2147483648::DOUBLE / ((next >> 33) + 1)::DOUBLE))::BIGINT
        FROM (SELECT *, (key * 2862933555777941757::UHUGEINT + 1) % 18446744073709551616::UHUGEINT AS next
              FROM jump WHERE target < n)),
    shards AS (
        SELECT doc_id, digest, max(pos) FILTER (WHERE n = 16) AS shard, max(pos) FILTER (WHERE n = 17) AS grown
        FROM jump WHERE target >= n GROUP BY ALL),
    crc_table AS (
        SELECT list(c ORDER BY i) AS entries FROM (
            SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k:
                CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS c
            FROM range(256) r(i))),
    sized AS (
        SELECT doc_id, strlen(coalesce(text, '')) + 1 AS size, hex(encode(coalesce(text, ''))) AS h FROM documents),
    crcs AS (
        SELECT doc_id, size, xor(4294967295, list_reduce(
                   list_prepend(4294967295::BIGINT, list_transform(range(1, size * 2 - 2, 2),
                       lambda p: ('0x' || substr(h, p, 2))::BIGINT)),
                   lambda c, b: xor(entries[xor(c & 255, b) + 1], c >> 8))) AS text_crc32
        FROM sized, crc_table)
    SELECT doc_id, size, text_crc32, 'key' AS law, shard::INT AS shard,
           row_number() OVER (PARTITION BY shard ORDER BY digest, doc_id, text_crc32) - 1 AS slot,
           grown::INT AS grown_shard
    FROM shards JOIN crcs USING (doc_id)
    """
)
def op5_jump_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    return sharding.assign_shards(docs, "doc_id", 16, tie="text_crc32")


@query(
    r"""
    WITH sized AS (
        SELECT doc_id, source, w, len(w) AS size,
               CASE WHEN len(w) = 0 THEN 0.05 ELSE greatest(0.05, len(list_distinct(w))::DOUBLE / len(w)) END AS quality
        FROM (SELECT doc_id, source, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents)),
    keyed AS (
        SELECT doc_id, source, size,
               -ln((('0x' || substr(md5('mix' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE + 0.5)
                   / 4503599627370496) / quality AS key
        FROM sized),
    sizes AS (
        SELECT source, sum(size)::BIGINT AS source_size, [5.0, 2.0, 1.0][(row_number() OVER
               (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight
        FROM keyed GROUP BY source),
    levels AS (
        SELECT *, (sum(source_size) OVER () - coalesce(sum(3.0::DOUBLE * source_size) OVER before, 0))
                  / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
        FROM sizes WINDOW before AS (ORDER BY source_size / weight, encode(source) NULLS LAST
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    plan AS (
        SELECT source, source_size, target, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs
        FROM (SELECT *, least(weight * (SELECT arg_min(level, source_size / weight) FROM levels
                                        WHERE level * weight <= 3 * source_size), 3.0::DOUBLE * source_size) AS target
              FROM levels)),
    summed AS (
        SELECT k.*, source_size, target, epochs, target - epochs * source_size AS budget,
               coalesce(sum(size) OVER (PARTITION BY k.source ORDER BY key, doc_id, size
                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
        FROM keyed k JOIN plan p ON k.source IS NOT DISTINCT FROM p.source),
    counted AS (
        SELECT *, (epochs + CASE WHEN epochs < 3 AND size > 0 AND before <= budget AND 2 * (budget - before) >= size
                                 THEN 1 ELSE 0 END)::INT AS times
        FROM summed)
    SELECT doc_id, size, source_size, round(target, 6) AS target, (times * size)::BIGINT AS taken FROM counted
    """
)
def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), "doc_id", "source", "text")
    return mixed.select("doc_id", "size", "source_size", F.round("target", 6).alias("target"), "taken")


@query(
    r"""
    WITH RECURSIVE found AS (
        SELECT url AS src, unnest([
            regexp_extract(regexp_extract(html, '<link\b[^>]*\brel\s*=\s*["'']?canonical\b[^>]*>', 0, 'is'),
                           '\bhref\s*=\s*["'']?\s*([^"''\s>]+)', 1, 'is'),
            regexp_extract(regexp_extract(html, '<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh\b[^>]*>', 0, 'is'),
                           '\burl\s*=\s*["'']?\s*([^"''\s>;]+)', 1, 'is')]) AS link
        FROM pages WHERE url IS NOT NULL),
    edges AS (
        SELECT DISTINCT split_part(src, '#', 1) AS a, split_part(CASE
            WHEN contains(link, '://') THEN link
            WHEN starts_with(link, '//') THEN split_part(src, '://', 1) || ':' || link
            WHEN starts_with(link, '/') THEN regexp_extract(src, '^[^:/?#]*://[^/?#]*') || link
            ELSE regexp_extract(src, '^[^:/?#]*://[^/?#]*')
                 || coalesce(nullif(regexp_extract(src, '^[^:/?#]*://[^/?#]*((?:/[^/?#]*)*/)', 1), ''), '/') || link
            END, '#', 1) AS b
        FROM found WHERE link <> ''),
    reach AS (
        SELECT a, b FROM edges UNION SELECT b, a FROM edges
        UNION SELECT r.a, e.b FROM reach r JOIN (SELECT a, b FROM edges UNION SELECT b, a FROM edges) e ON r.b = e.a),
    rules AS (SELECT * FROM (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'),
                                    ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')) v(verdict, name, start)),
    urls AS (SELECT url AS u FROM pages UNION SELECT a FROM edges UNION SELECT b FROM edges),
    parts AS (
        SELECT u, lower(regexp_extract(rest, '^[^/?#]*')) AS host,
               regexp_extract(rest, '^[^/?#]*(/[^?#]*)', 1) AS path
        FROM (SELECT u, CASE WHEN contains(u, '://') THEN substr(u, strpos(u, '://') + 3) ELSE '' END AS rest FROM urls)),
    ruled AS (
        SELECT u, host, path, arg_max(name || start, length(name || start)) AS rule,
               arg_max(verdict, length(name || start)) AS verdict
        FROM parts LEFT JOIN rules ON (host = name OR ends_with(host, '.' || name)) AND starts_with(path, start)
        GROUP BY ALL),
    aliases AS (
        SELECT r.a, min(v.verdict) AS verdict FROM reach r JOIN ruled v ON r.b = split_part(v.u, '#', 1)
        WHERE v.verdict IS NOT NULL GROUP BY ALL)
    SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, rule,
           coalesce(r.verdict, x.verdict, 'allow') AS verdict
    FROM pages LEFT JOIN ruled r ON url = u LEFT JOIN aliases x ON x.a = split_part(url, '#', 1)
    """
)
def op9_url_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    judged = url_rules.judge_urls(pages, "url", url_rules.RULES, html="html")
    return judged.select("page_id", "host", "path", "rule", "verdict")


@query()
def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    packed = packing.pack_documents(docs, "doc_id", "text", public_tokenizers.path("byte_bpe_50k.json"))
    return packed.withColumnRenamed("id", "doc_id")


@query()
def op4_lattice_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = held_out_by(F.col("doc_id"), 7, 2)
    scored = lattice_lm.score(docs, "doc_id", "text", ~held_out, public_tokenizers.path("piece_bpe_32k.model"))
    return scored.withColumn("held_out", held_out)


@query()
def op8_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return multi_index.search(rows, "vec_id", "embedding", F.col("id") % 20 == 0)


@query()
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    held_out = held_out_by(F.col("doc_id"), 4, 2)
    scored = toxicity.score(docs, "doc_id", "text", labels, "doc_id", "toxic", train=~held_out)
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


@query()
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    held_out = held_out_by(F.col("doc_id"), 5, 0)
    scored = quality.score(docs, "doc_id", "text", labels, "doc_id", "quality", train=~held_out, keep=["doc_id"])
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


@query(
    r"""
    WITH RECURSIVE t AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
    words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos, len(w) AS n FROM t),
    runs AS (
        SELECT doc_id, pos, n, word || coalesce(' ' || lead(word) OVER p, '') || coalesce(' ' || lead(word, 2) OVER p, '')
               || coalesce(' ' || lead(word, 3) OVER p, '') || coalesce(' ' || lead(word, 4) OVER p, '') AS shingle
        FROM words WINDOW p AS (PARTITION BY doc_id ORDER BY pos)),
    e AS (SELECT DISTINCT doc_id, shingle FROM runs WHERE pos <= greatest(1, n - 4)),
    s AS (SELECT doc_id, coalesce(g, []) AS g FROM documents LEFT JOIN
              (SELECT doc_id, list(shingle ORDER BY shingle) AS g FROM e GROUP BY doc_id) USING (doc_id)),
    pairs AS (
        SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
        FROM e a JOIN e b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
    linked AS (
        SELECT a, b FROM pairs JOIN s x ON a = x.doc_id JOIN s y ON b = y.doc_id
        WHERE 10 * shared >= 8 * (len(x.g) + len(y.g) - shared)),
    reach AS (
        SELECT doc_id AS a, doc_id AS b FROM documents
        UNION SELECT r.a, l.b FROM reach r JOIN linked l ON r.b = l.a),
    classes AS (SELECT a, min(b) AS class_id FROM reach GROUP BY a),
    numbers AS (SELECT a, count(*) AS links FROM linked GROUP BY a)
    SELECT s.doc_id, class_id, coalesce(links, 0) AS links,
           CASE WHEN len(g) = 0 THEN 1 ELSE count(*) OVER (PARTITION BY g) END AS copies
    FROM s JOIN classes c ON s.doc_id = c.a LEFT JOIN numbers n ON s.doc_id = n.a
    """
)
def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_documents(table(spark, sf_dir, "documents"), "doc_id", "text")


# A path is its cost in nine digits and its letters, so the least text is the cheapest path, ties by letters.
def _edit(path: str, cost: str, letter: str) -> str:
    return f"(lpad((substr({path}, 1, 9)::BIGINT + {cost})::VARCHAR, 9, '0') || substr({path}, 10) || '{letter}')"


def _inserted(e: str, s: str, u: str, a: str) -> str:
    """The paths of the states (nothing yet, after s, after u, after a) with insertions behind them."""
    step = lambda x: _edit(x, "3", "I")  # noqa: E731
    return f"""
        SELECT * REPLACE (least(u, {step("a")}) AS u) FROM (
            SELECT * REPLACE (least(a, {step("u")}) AS a) FROM (
                SELECT * EXCLUDE (e0, s0, u0, a0), e0 AS e, s0 AS s,
                       least(u0, {step("e0")}, {step("s0")}, {step("a0")}) AS u, a0 AS a
                FROM (SELECT *, {e} AS e0, {s} AS s0, {u} AS u0, {a} AS a0 FROM _from_)))"""


def _kept(path: str, initial: str) -> str:
    return f"CASE WHEN NOT must AND initial = '{initial}' THEN {_edit(path, 'extra', 'K')} END"


def _reroled(path: str) -> str:
    return f"CASE WHEN NOT must THEN {_edit(path, '3 + extra', 'R')} END"


def _deleted(path: str) -> str:
    return _edit(path, "4", "D")


_REPAIR_SQL = rf"""
    WITH RECURSIVE crc_table AS (
        SELECT list(c ORDER BY i) AS entries FROM (
            SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k:
                CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS c
            FROM range(256) r(i))),
    keyed AS (
        SELECT *, hex(encode(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))) AS h,
               dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS c
        FROM conversations),
    coded AS (
        SELECT c, conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
               xor(4294967295, list_reduce(
                   list_prepend(4294967295::BIGINT, list_transform(range(1, len(h), 2), lambda p: ('0x' || substr(h, p, 2))::BIGINT)),
                   lambda r, b: xor(entries[xor(r & 255, b) + 1], r >> 8))) % 20 AS what
        FROM keyed, crc_table),
    damaged AS (
        SELECT c, turn, CASE what WHEN 4 THEN 'user' ELSE role END AS role,
               CASE what WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
        FROM coded, range(2) t(again) WHERE what <> 0 AND (again = 0 OR what = 3)),
    placed AS (
        SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, encode(role), encode(text)) AS pos FROM damaged),
    faults AS (
        SELECT *, substr(role, 1, 1) AS initial, rtrim(text, E' 	
') AS body,
               row_number() OVER (PARTITION BY c, role, text ORDER BY pos) > 1 AS again FROM placed),
    facts AS (
        SELECT *, body = '' AS blank, body <> '' AND again AS duplicate,
               body <> '' AND NOT again AND right(body, 1) NOT IN ('.', '!', '?') AS truncated, blank OR duplicate AS must,
               CASE WHEN truncated THEN 3 ELSE 0 END AS extra,
               lag(initial) OVER (PARTITION BY c ORDER BY pos) AS before
        FROM faults),
    dp AS (
        SELECT c, 0::BIGINT AS pos, e, s, u, a FROM ({_inserted("'000000000'", "NULL::VARCHAR", "NULL::VARCHAR", "NULL::VARCHAR").replace("_from_", "(SELECT DISTINCT c FROM coded)")})
        UNION ALL
        SELECT c, pos, e, s, u, a FROM ({
    _inserted(
        _deleted("e"),
        f"least({_deleted('s')}, {_kept('e', 's')})",
        "least(" + ", ".join([_deleted("u"), *(_reroled(x) for x in "esa"), *(_kept(x, "u") for x in "esa")]) + ")",
        f"least({_deleted('a')}, {_reroled('u')}, {_kept('u', 'a')})",
    ).replace("_from_", "(SELECT f.c, f.pos, f.initial, f.must, f.extra, d.e, d.s, d.u, d.a FROM dp d JOIN facts f ON f.c = d.c AND f.pos = d.pos + 1)").replace("* EXCLUDE (e0, s0, u0, a0)", "c, pos")
})),
    best AS (
        SELECT c, least(e, a) AS path, substr(path, 1, 9)::BIGINT AS cost, substr(path, 10) AS audit
        FROM dp WHERE pos = (SELECT count(*) FROM facts f WHERE f.c = dp.c)),
    letters AS (
        SELECT c, j, substr(audit, j, 1) AS letter FROM (SELECT c, audit, unnest(range(1, len(audit) + 1)) AS j FROM best)),
    edits AS (
        SELECT *, count(*) FILTER (letter <> 'I') OVER w AS pos, count(*) FILTER (letter <> 'D') OVER w AS k
        FROM letters WINDOW w AS (PARTITION BY c ORDER BY j)),
    lines AS (
        SELECT d.c, d.j, d.k, d.letter, f.role, f.text, f.initial,
               bool_or(d.k = 1 AND d.letter = 'K' AND f.initial = 's') OVER (PARTITION BY d.c) AS has_s
        FROM edits d LEFT JOIN facts f ON f.c = d.c AND f.pos = d.pos WHERE d.letter <> 'D'),
    repaired AS (
        SELECT c, string_agg(CASE WHEN letter = 'K' THEN role WHEN (k % 2 = 0) = has_s THEN 'user' ELSE 'assistant' END
                             || ':' || CASE WHEN letter = 'I' THEN '' ELSE text END, chr(10) ORDER BY j) AS whole
        FROM lines GROUP BY c),
    counts AS (
        SELECT c, count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate,
               count(*) FILTER (truncated) AS truncated,
               count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal,
               coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps
        FROM facts GROUP BY c)
    SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
           coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, cost, audit,
           sha256(coalesce(whole, '')) AS repaired_sha256
    FROM (SELECT DISTINCT c, conv_id FROM coded) JOIN best USING (c) LEFT JOIN counts USING (c) LEFT JOIN repaired USING (c)
    """


@query(_REPAIR_SQL)
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    hurt = conversation_repair.damage(rows, "conv_id", "turn", "role", "text")
    return conversation_repair.repair(hurt, "conv_id", "turn", "role", "text").withColumnRenamed("conv", "conv_id")


@query()
def op12_slack_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    packed = slack_packing.pack_documents(docs, "doc_id", "text", public_tokenizers.path("byte_bpe_50k.json"))
    return packed.withColumnRenamed("id", "doc_id")


@query(
    r"""
    WITH docs AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                    'abcdefghijklmnopqrstuvwxyz'),
                                          '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
    stats AS (SELECT count(*) FILTER (len(t) > 0) AS many, sum(len(t))::BIGINT AS total FROM docs),
    tfs AS (SELECT doc_id, n, term, count(*) AS tf
            FROM (SELECT doc_id, len(t) AS n, unnest(t) AS term FROM docs) GROUP BY ALL),
    dfs AS (SELECT term, count(*) AS df FROM tfs GROUP BY term),
    asked AS (
        SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                                     'abcdefghijklmnopqrstuvwxyz'),
                                                           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM benchmark),
    scored AS (
        SELECT item_id, doc_id, sum(floor(1000 * ln((2 * many + 2) / (2 * df + 1)))::BIGINT
                   * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * many) // total))))::BIGINT AS score
        FROM asked JOIN dfs USING (term) JOIN tfs USING (term), stats GROUP BY ALL)
    SELECT item_id, rank::INT AS rank, doc_id, score
    FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
          FROM scored WHERE score > 0) WHERE rank <= 10
    """
)
def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return ranked_search.rank(docs, "doc_id", "text", items, "item_id", "text")
