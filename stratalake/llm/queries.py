"""The registered queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm import ann, audit, bpe, jaccard, language, minhash, mixing, outliers, repeats, runs, tokencount, toxicity, urlmodel

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def wrap(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return wrap


def tokenizer(name: str) -> str:
    """Where the file of a public tokenizer lies, here and on the executors."""
    import public_tokenizers

    return public_tokenizers.path(name)


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


SQL_WORDS = r"regexp_extract_all(coalesce({0}, ''), '[^\x20\x09-\x0D]+')"


@query(
    rf"""
    WITH RECURSIVE lowered AS (
        SELECT doc_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
    ), words AS (
        SELECT doc_id, {SQL_WORDS.format("t")} AS w FROM lowered
    ), shingles AS (
        SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
            ELSE list_distinct([array_to_string(w[i:i + 3], ' ') FOR i IN range(1, len(w) - 2)]) END) AS s
        FROM words
    ), sizes AS (
        SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
    ), links AS (
        SELECT a.doc_id AS a, b.doc_id AS b
        FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
            JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
        WHERE 100 * least(x.n, y.n) >= 85 * greatest(x.n, y.n)
        GROUP BY a.doc_id, b.doc_id, x.n, y.n
        HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))
    ), reach AS (
        SELECT doc_id AS a, doc_id AS b FROM documents
        UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
    )
    SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, min(r.b) AS component_id
    FROM documents d JOIN reach r ON r.a = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id
    GROUP BY d.doc_id, s.n
    """
)
def op1_jaccard_join(spark, folder):
    """One row per document with its group; a copy stands for its class, so no pairs of copies are made."""
    return jaccard.jaccard_groups(documents(spark, folder)).select("doc_id", "n_shingles", "component_id")


@query()
def op5_token_counts(spark, folder):
    """Tokens of every document and whether they are more than fit a context of 1,024."""
    return tokencount.token_counts(documents(spark, folder), tokenizer("byte_bpe_50k.json"), limit=1024)


@query()
def op6_bpe_round_trip(spark, folder):
    """Digests of every document's ids and of the text they decode to."""
    path = tokenizer("byte_bpe_50k.json")
    return bpe.digests(bpe.decode(bpe.encode(documents(spark, folder), path), path))


@query(
    rf"""
    WITH words AS (
        SELECT doc_id, {SQL_WORDS.format("text")} AS w FROM documents
    ), windows AS (
        SELECT doc_id, unnest(range(1, len(w) - 18)) AS i, w FROM words
    ), later AS (
        SELECT doc_id, i
        FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY array_to_string(w[i:i + 19], ' ') ORDER BY doc_id, i) AS r FROM windows)
        WHERE r > 1
    ), gone AS (
        SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM later
    ), each_word AS (
        SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM words
    ), kept AS (
        SELECT e.doc_id, string_agg(word, ' ' ORDER BY e.i) AS text, count(*) AS n
        FROM each_word e LEFT JOIN gone g ON g.doc_id = e.doc_id AND g.i = e.i
        WHERE g.i IS NULL GROUP BY e.doc_id
    )
    SELECT words.doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
    FROM words LEFT JOIN kept ON kept.doc_id = words.doc_id
    """
)
def op9_substring_dedup(spark, folder):
    """Every document without the 20-word windows that occur earlier."""
    return repeats.without_repeats(documents(spark, folder)).select("doc_id", "n_words", "n_removed", "kept_sha256")


def _quality_sql(least: int = 200, share: float = 0.75, rounds: int = 4, usual: float = 12.83, cut: float = 20.515) -> str:
    """The same estimates round by round; the formulas come from the module, the scans, bins and joins are spelled out here."""
    xs = outliers.DIMENSIONS
    columns = ", ".join(outliers.factor_columns())

    def factors(name: str, source: str) -> str:
        sql = "SELECT pool, " + ", ".join(f"{f} AS {n}" for n, f in outliers.moments_sql()) + f" FROM {source} GROUP BY pool"
        for n, f in outliers.cholesky_steps():
            sql = f"SELECT *, {f} AS {n} FROM ({sql})"
        return f"{name} AS MATERIALIZED (SELECT pool, {columns} FROM ({sql}))"

    def near(k: int, within: float) -> list[str]:
        return [
            f"d{k} AS MATERIALIZED (SELECT p.*, {outliers.distance_sql()} AS d2 FROM passed p JOIN f{k} USING (pool))",
            f"b{k} AS MATERIALIZED (SELECT *, floor(ln(1 + d2) * {outliers.BINS})::BIGINT AS bin FROM d{k})",
            f"""t{k} AS MATERIALIZED (
                SELECT pool, min(bin) AS most FROM (
                    SELECT pool, bin, sum(c) OVER (PARTITION BY pool ORDER BY bin) AS upto, sum(c) OVER (PARTITION BY pool) AS n
                    FROM (SELECT pool, bin, count(*) AS c FROM b{k} GROUP BY pool, bin))
                WHERE upto >= {share} * n GROUP BY pool)""",
            factors(f"f{k + 1}", f"(SELECT b{k}.* FROM b{k} JOIN t{k} USING (pool) WHERE bin <= most OR d2 <= {within})"),
        ]

    start = []
    for i, x in enumerate(xs):
        start.append(
            f"""q{i} AS (
                SELECT pool, min(CASE WHEN upto >= 0.25 * n THEN (bin + 0.5) / {outliers.BINS} END) AS lo,
                    min(CASE WHEN upto >= 0.5 * n THEN (bin + 0.5) / {outliers.BINS} END) AS mid,
                    min(CASE WHEN upto >= 0.75 * n THEN (bin + 0.5) / {outliers.BINS} END) AS hi
                FROM (SELECT pool, bin, sum(c) OVER (PARTITION BY pool ORDER BY bin) AS upto, sum(c) OVER (PARTITION BY pool) AS n
                    FROM (SELECT pool, floor({x} * {outliers.BINS})::BIGINT AS bin, count(*) AS c FROM passed GROUP BY 1, 2))
                GROUP BY pool)"""
        )
    first = ", ".join(f"q{i}.mid AS m_{i}" for i in range(len(xs)))
    for i, x in enumerate(xs):
        for j in range(i + 1):
            scale = f"1 / sqrt(power((q{i}.hi - q{i}.lo) / 1.349, 2) + {outliers.TRANSFORMS[x][1] ** 2})"
            first += f", {scale if i == j else '0.0'} AS r_{i}{j}"
    joins = "".join(f" JOIN q{i} USING (pool)" for i in range(1, len(xs)))
    steps = [s for k in range(rounds) for s in near(k, 0.0)] + near(rounds, usual)
    return rf"""
    WITH split AS MATERIALIZED (
        SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text, {SQL_WORDS.format("text")} AS w,
            [x FOR x IN string_split(coalesce(text, ''), chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines
        FROM documents
    ), windows AS (
        SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS times FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM split)
    ), repeated AS (
        SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM windows WHERE times > 1) GROUP BY doc_id
    ), counted AS MATERIALIZED (
        SELECT s.doc_id, lang, source, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
            length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
            len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words
        FROM split s LEFT JOIN repeated r ON r.doc_id = s.doc_id
    ), stats AS MATERIALIZED (
        SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, {", ".join(f"({sql})::DOUBLE AS {x}" for x, (sql, _) in outliers.TRANSFORMS.items())}
        FROM counted
    ), sizes AS (
        SELECT lang, source, count(*) AS n FROM stats WHERE NOT base_failed GROUP BY lang, source
    ), pools AS (
        SELECT lang, source, CASE WHEN n >= {least} THEN 'source ' || lang || ' ' || source
            WHEN sum(CASE WHEN n < {least} THEN n ELSE 0 END) OVER (PARTITION BY lang) >= {least} THEN 'lang ' || lang ELSE 'rest' END AS pool
        FROM sizes
    ), passed AS MATERIALIZED (
        SELECT doc_id, pool, {", ".join(xs)} FROM stats JOIN pools USING (lang, source) WHERE NOT base_failed
    ), {", ".join(start)}, f0 AS MATERIALIZED (SELECT pool, {first} FROM q0{joins}), {", ".join(steps)},
    judged AS (SELECT p.doc_id, {outliers.distance_sql()} AS d2 FROM passed p JOIN f{rounds + 1} USING (pool))
    SELECT s.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, coalesce(d2 <= {cut}, false) AS kept
    FROM stats s LEFT JOIN judged j ON j.doc_id = s.doc_id
    """


@query(_quality_sql())
def op3_quality_rules(spark, folder):
    """Fixed rules and robust outliers of every document's statistics, by language and source."""
    return outliers.quality_verdicts(documents(spark, folder)).drop("distance")


URL_RULES = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block")]


@query()
def op4_url_filters(spark, folder):
    """Every page's URL by the rules, or by character models where none fits."""
    return urlmodel.judge_urls(spark.read.parquet(f"{folder}/pages.parquet"), URL_RULES)


@query()
def op7_language_id(spark, folder):
    """Every document's language, learnt from the documents that are not held out."""
    return language.identify_languages(documents(spark, folder), tokenizer("piece_bpe_32k.model"))


@query()
def op10_toxicity(spark, folder):
    """Every document's toxicity, learnt from the labels that are not held out."""
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    return toxicity.score_toxicity(documents(spark, folder), labels).drop("segments")


@query()
def op8_nearest_neighbours(spark, folder):
    """The 20 nearest vectors found for every twentieth one."""
    return ann.nearest(spark.read.parquet(f"{folder}/embeddings.parquet"))


#: Part of all tokens that the sample is to have.
SAMPLE_SHARE = 0.5


def _mixing_sql(rounds: int = mixing.ROUNDS, temper: float = mixing.TEMPER, part: float = SAMPLE_SHARE) -> str:
    """Raking step by step; the scale is the greatest that any number of whole cells, in order of weight, asks of the others."""
    topic = (
        r"CASE WHEN regexp_matches(coalesce(text, ''), '\|[^|\n]*\|[^|\n]*\|') THEN 'listing' "
        "WHEN regexp_matches(coalesce(text, ''), '(?i)licen[cs]e|copyright|all rights reserved') THEN 'notice' "
        "WHEN regexp_matches(coalesce(text, ''), '[A-Za-z0-9]@[A-Za-z0-9]|https?://') THEN 'contact' ELSE 'prose' END"
    )
    step, shares = "cells", []
    for m in mixing.MARGINS:
        shares.append(f"share_{m} AS (SELECT {m}, pow(t, {temper}) / sum(pow(t, {temper})) OVER () AS share FROM (SELECT {m}, sum(tokens) AS t FROM cells GROUP BY {m}))")
    steps = []
    for r in range(rounds):
        for m in mixing.MARGINS:
            name = f"w{r}_{m}"
            steps.append(
                f"{name} AS MATERIALIZED (SELECT c.* REPLACE (f * CASE WHEN s > 0 THEN share * total / s ELSE 1 END AS f) FROM "
                f"(SELECT *, sum(tokens * f) OVER (PARTITION BY {m}) AS s_{r}_{m} FROM {step}) c JOIN share_{m} USING ({m}), LATERAL (SELECT s_{r}_{m} AS s))"
            )
            step = name
    return f"""
    WITH rows AS MATERIALIZED (
        SELECT doc_id, len({SQL_WORDS.format("text")}) AS n_tokens, coalesce(source, '') AS source, coalesce(lang, '') AS lang, {topic} AS topic,
            ('0x' || md5(doc_id::VARCHAR)[1:13])::BIGINT / 4503599627370496.0::DOUBLE AS u
        FROM documents
    ), cells AS MATERIALIZED (
        SELECT source, lang, topic, sum(n_tokens)::DOUBLE AS tokens, 1.0::DOUBLE AS f, (SELECT sum(n_tokens) FROM rows)::DOUBLE AS total FROM rows GROUP BY ALL
    ), {", ".join(shares)}, {", ".join(steps)},
    ordered AS (
        SELECT total, coalesce(sum(tokens) OVER before, 0) AS taken, sum(tokens * f) OVER (ORDER BY f DESC, source, lang, topic ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest
        FROM {step} WHERE tokens > 0 AND f > 0 WINDOW before AS (ORDER BY f DESC, source, lang, topic ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    ), scale AS (
        SELECT max(({part} * total - taken) / rest) AS c FROM ordered
    ), chance AS (SELECT source, lang, topic, f, least(1.0, f * c) AS p FROM {step}, scale)
    SELECT doc_id, n_tokens, topic, round(f, 6) AS weight, round(p, 6) AS probability, u < p AS selected
    FROM rows JOIN chance USING (source, lang, topic)
    """


@query(_mixing_sql())
def op2_mixing(spark, folder):
    """Every document's weight and whether it is in a sample of half of all tokens, with tempered shares of sources, languages and topics."""
    rows = mixing.mix(documents(spark, folder), share=SAMPLE_SHARE, carry=["doc_id"])
    return rows.select("row.doc_id", "n_tokens", "topic", F.round("weight", 6).alias("weight"), F.round("probability", 6).alias("probability"), "selected")


#: CRC-32 of an id's decimal digits: every byte goes in from below, eight shifts each with the reversed polynomial.
_CRC_SQL = (
    "xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({0}::VARCHAR, ''), lambda x: ascii(x)::BIGINT)), "
    "lambda c, b: list_reduce(list_prepend(xor(c, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, i: xor(x >> 1, (x & 1) * 3988292384))), 4294967295)"
)


def _runs_sql(levels: int = 17) -> str:
    """Factors of 1, 2, 4 … words are named by rank; equal distances to the next occurrence side by side are a run. Right for texts of up to ``4 * 2 ** (levels - 1)`` words."""
    steps = []
    for k in range(levels):
        names = "SELECT doc_id, i, dense_rank() OVER (ORDER BY doc_id, word) AS name FROM words"
        if k:
            names = (
                f"SELECT a.doc_id, a.i, dense_rank() OVER (ORDER BY a.name, b.name) AS name FROM level{k - 1} a "
                f"JOIN level{k - 1} b ON b.doc_id = a.doc_id AND b.i = a.i + {1 << (k - 1)}"
            )
        steps.append(f"level{k} AS MATERIALIZED (SELECT * FROM ({names}) QUALIFY count(*) OVER (PARTITION BY name) > 1)")
        near = f"gap <= {1 << k} AND 2 * gap > {1 << k}"
        steps.append(
            f"runs{k} AS (SELECT doc_id, min(i) AS start, max(i) - min(i) + {1 << k} + gap AS length, gap AS period FROM "
            f"(SELECT doc_id, i, gap, i - row_number() OVER (PARTITION BY doc_id, gap ORDER BY i) AS island FROM "
            f"(SELECT doc_id, i, lead(i) OVER (PARTITION BY name ORDER BY i) - i AS gap FROM level{k}) WHERE {near}) "
            f"GROUP BY doc_id, gap, island HAVING length >= greatest(6, 4 * gap))"
        )
    every = " UNION ALL ".join(f"SELECT * FROM runs{k}" for k in range(levels))
    return rf"""
    WITH own AS (
        SELECT doc_id, {SQL_WORDS.format("text")} AS w, {_CRC_SQL.format("doc_id")} AS h FROM documents
    ), places AS (
        SELECT *, (h // 10) % greatest(len(w), 1) AS a, 1 + (len(w) - (h // 10) % greatest(len(w), 1)) // (3 + (h // 10) % 8) AS p FROM own
    ), words AS MATERIALIZED (
        SELECT doc_id, i, w[1 + CASE WHEN h % 10 = 0 AND i >= a THEN a + (i - a) % p ELSE i END] AS word
        FROM (SELECT *, unnest(range(len(w))) AS i FROM places)
    ), {", ".join(steps)}, runs AS MATERIALIZED ({every}), listed AS (
        SELECT doc_id, count(*) AS n_runs, first({{'start': start, 'length': length, 'period': period}} ORDER BY length DESC, start, period) AS best,
            string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines
        FROM runs GROUP BY doc_id
    ), gone AS (
        SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs
    ), kept AS (
        SELECT words.doc_id, string_agg(word, ' ' ORDER BY words.i) AS text FROM words LEFT JOIN gone USING (doc_id, i) WHERE gone.i IS NULL GROUP BY words.doc_id
    )
    SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, best.start AS start, best.length AS length, best.period AS period,
        1000 * best.length // best.period AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
    FROM documents d LEFT JOIN listed USING (doc_id) LEFT JOIN kept USING (doc_id)
    """


@query(_runs_sql())
def op11_periodic_runs(spark, folder):
    """Every document's periodic runs, one in ten with a planted one, and the text with every run cut to its first period."""
    return runs.find_runs(documents(spark, folder), rewrite=runs.planted).drop("runs")


@query(
    rf"""
    WITH texts AS (
        SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, {SQL_WORDS.format("text")} AS w FROM documents
    ), earliest AS (
        SELECT t, min(doc_id) AS first FROM texts GROUP BY t
    ), marks AS (
        SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id
    ), kinds AS MATERIALIZED (
        SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, count(*) AS n,
            concat(CASE WHEN len(w) < 100 THEN 'A' END, CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' END,
                CASE WHEN 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 10 * length(t) THEN 'C' END,
                CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' END, CASE WHEN doc_id > first THEN 'E' END) AS fails
        FROM texts JOIN earliest USING (t) LEFT JOIN marks USING (doc_id) GROUP BY ALL
    ), letters AS (
        SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
    ), steps AS (
        SELECT filter_order, step, substr(filter_order, step, 1) AS letter, substr(filter_order, 1, step - 1) AS earlier
        FROM (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order, unnest([1, 2, 3, 4, 5]) AS step
            FROM letters a JOIN letters b ON b.x <> a.x JOIN letters c ON c.x NOT IN (a.x, b.x)
                JOIN letters d ON d.x NOT IN (a.x, b.x, c.x) JOIN letters e ON e.x NOT IN (a.x, b.x, c.x, d.x))
    ), outcomes AS (
        SELECT part, filter_order, step, letter, n, good, toxic, fails = letter AS alone, contains(fails, letter) AS failing,
            length(translate(earlier, fails, '')) < length(earlier) AS gone
        FROM kinds, steps
    ), summed AS (
        SELECT part, filter_order, step, letter,
            sum(CASE WHEN NOT gone AND NOT failing THEN n ELSE 0 END)::BIGINT AS kept, sum(CASE WHEN failing AND NOT gone THEN n ELSE 0 END)::BIGINT AS removed,
            sum(CASE WHEN failing AND gone THEN n ELSE 0 END)::BIGINT AS redundant, sum(CASE WHEN alone THEN n ELSE 0 END)::BIGINT AS unique_fails,
            sum(CASE WHEN failing AND NOT gone AND good THEN n ELSE 0 END)::BIGINT AS good_lost,
            sum(CASE WHEN failing AND NOT gone AND toxic THEN n ELSE 0 END)::BIGINT AS toxic_lost
        FROM outcomes GROUP BY ALL
    )
    SELECT * EXCLUDE (letter), sum(removed) OVER (PARTITION BY part, letter)::BIGINT AS shapley FROM summed
    """
)
def op12_filter_audit(spark, folder):
    """What five filters remove at every step of all their orders, by language."""
    return audit.audit_documents(documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet"))


@query(
    rf"""
    WITH RECURSIVE lowered AS (
        SELECT doc_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
    ), words AS (
        SELECT doc_id, {SQL_WORDS.format("t")} AS w FROM lowered
    ), shingles AS (
        SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 2 THEN [w[1]]
            ELSE list_distinct([w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]) END) AS s
        FROM words
    ), sizes AS (
        SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
    ), links AS (
        SELECT a.doc_id AS a, b.doc_id AS b
        FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
            JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
        WHERE 100 * least(x.n, y.n) >= 80 * greatest(x.n, y.n)
        GROUP BY a.doc_id, b.doc_id, x.n, y.n
        HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))
    ), reach AS (
        SELECT doc_id AS a, doc_id AS b FROM documents
        UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
    )
    SELECT *, doc_id = component_id AS kept FROM (
        SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, min(r.b) AS component_id
        FROM documents d JOIN reach r ON r.a = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id GROUP BY d.doc_id, s.n)
    """
)
def op13_minhash_dedup(spark, folder):
    """Every document's group of near copies, by MinHash tables whose keys combine two small collections."""
    return minhash.minhash_groups(documents(spark, folder))
