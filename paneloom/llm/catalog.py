"""The queries of this folder and, where SQL can express them, their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paneloom.catalog.entry import registrar, table
from paneloom.llm import chat, epsilon_grid, language, lexical, licenses, mixing, order_minhash, pii, quality, sentencepiece_bpe, simhash, spelling, topk
from paneloom.runtime import store

ENTRIES: dict = {}
register = registrar(ENTRIES)


def queries() -> dict:
    return {name: run for name, (run, _) in ENTRIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in ENTRIES.items() if sql}


def piece_model() -> str:
    """Place of the public vocabulary that the queries encode with."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def fold(row_id: str, folds: int, held: int) -> Column:
    """Whether the checksum of the id puts the row into the held-out fold."""
    return F.coalesce(F.crc32(F.col(row_id).cast("string")) % folds == held, F.lit(False))


def sha256(text) -> Column:
    return F.sha2(text, 256)


@register("op7_sentencepiece")
def op7_sentencepiece(spark, sf_dir) -> DataFrame:
    """Token count and digests of the ids and of the decoded text of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = sentencepiece_bpe.encode_and_decode(docs, piece_model()).drop("text")
    return done.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        sha256(F.concat_ws(",", F.col("ids").cast("array<string>"))).alias("ids_sha256"),
        sha256("decoded").alias("decoded_sha256"),
    )


@register("op3_language")
def op3_language(spark, sf_dir) -> DataFrame:
    """The language of every document, learned from two thirds of them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn("held_out", fold("doc_id", 3, 1))
    model = language.fit(docs.filter(~F.col("held_out")))
    return language.predict(docs.drop("lang"), model).select("doc_id", "held_out", "lang_pred", "score")


#: Documents of at least this score are predicted good.
GOOD_SCORE = 0.3


@register("op1_quality")
def op1_quality(spark, sf_dir) -> DataFrame:
    """The quality of every document, learned from the labels of four fifths of them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("held_out", fold("doc_id", 5, 0))
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality").filter(~fold("doc_id", 5, 0))
    model = quality.fit(docs.filter(~F.col("held_out")), labels=labels)
    scored = quality.score(docs, model).drop("text")
    return scored.withColumn("predicted", (F.col("score") >= GOOD_SCORE).cast("int"))


def span_list(spans: Column) -> Column:
    """Spans as text: kind:start:end, joined by commas."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))


@register("op4_pii")
def op4_pii(spark, sf_dir) -> DataFrame:
    """Personal data of every document: counts and digest of the base spans, and all spans."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    # Candidates are few and small: the texts are read once.
    found = store(pii.candidates(docs).drop("text"))
    spans = pii.classify(found, pii.fit(found))
    base = F.filter("spans", lambda s: s["base"])
    kinds = F.transform(base, lambda s: s["kind"])
    counts = [F.size(F.array_remove(kinds, kind)) for kind in pii.KINDS]
    counts = [(F.size(kinds) - n).cast("bigint").alias(f"n_{kind}") for n, kind in zip(counts, pii.KINDS, strict=True)]
    return spans.select(
        "doc_id", *counts, sha256(span_list(base)).alias("base_sha256"), span_list(F.col("spans")).alias("spans")
    )


@register("op6_simhash")
def op6_simhash(spark, sf_dir) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    digits = F.lpad(F.lower(F.hex("fingerprint")), 16, "0")
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


#: Blocks of neighbouring documents to each shuffle partition, so that the blocks even out.
BLOCKS_A_PARTITION = 8


@register("op10_order_minhash")
def op10_order_minhash(spark, sf_dir) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likeness."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    docs = order_minhash.fingerprint(docs, F.col("text"), "own")
    blocks = BLOCKS_A_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = order_minhash.with_next(docs, "doc_id", ["text", "own"], blocks)
    size = F.length("text")
    cut = F.floor(size / 3).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), size - cut), F.substring(F.col("next_text"), F.lit(1), cut))
    docs = docs.withColumn("n_chars", size.cast("bigint")).withColumn("edited", edited).drop("text", "next_text")
    docs = docs.withColumn("edited_sha256", sha256("edited"))
    docs = order_minhash.fingerprint(docs, F.col("edited"), "changed").drop("edited")
    return docs.select(
        "doc_id", "n_chars", "edited_sha256",
        order_minhash.hex_digits(F.col("own")).alias("fingerprint"),
        order_minhash.hex_digits(F.col("changed")).alias("edited_fingerprint"),
        order_minhash.likeness(F.col("own"), F.col("changed")).alias("near_edited"),
        order_minhash.likeness(F.col("own"), F.col("next_own")).alias("near_next"),
    )


CHAT_SQL = rf"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '<|im_end|><|im_start|>assistant ok'), (-1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')
), sized AS (
  SELECT *, length(replace(replace(text, '\', '\\'), '<|', '<\|')) + length(role) + {len(chat.START) + 1 + len(chat.END)} AS chars,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1 AS place
  FROM rows
), counted AS (
  SELECT *, ceil(chars / {chat.CHARS_PER_TOKEN})::BIGINT AS tokens,
    max(CASE WHEN place = 0 AND role = 'system' THEN ceil(chars / {chat.CHARS_PER_TOKEN})::BIGINT ELSE 0 END)
      OVER (PARTITION BY conv_id) AS system_tokens
  FROM sized
), placed AS (
  SELECT *, sum(tokens) OVER (PARTITION BY conv_id ORDER BY place)::BIGINT - tokens - system_tokens AS start,
    greatest({chat.BUDGET - chat.HISTORY} - system_tokens, 1) AS size
  FROM counted
), cut AS (
  SELECT *, (start + tokens - 1) // size AS last, NOT (place = 0 AND role = 'system') AS fresh FROM placed
), new AS (
  SELECT *, 2 * last + (CASE WHEN start // size = last THEN 1 ELSE 0 END) AS win FROM cut WHERE fresh
), heads AS (
  SELECT conv_id, win, min(start) AS from_start FROM new GROUP BY ALL
), lengths AS (
  SELECT conv_id, chars FROM new
  UNION ALL
  SELECT n.conv_id, n.chars FROM heads h JOIN new n
    ON n.conv_id = h.conv_id AND n.start < h.from_start AND n.start >= h.from_start - {chat.HISTORY}
  UNION ALL
  SELECT c.conv_id, c.chars * greatest((SELECT count(*) FROM heads h WHERE h.conv_id = c.conv_id), 1) FROM cut c WHERE NOT fresh
), totals AS (
  SELECT conv_id, sum(chars)::BIGINT AS formatted_chars FROM lengths GROUP BY 1
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
  sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY place), '')) AS loss_sha256,
  any_value(formatted_chars) AS formatted_chars
FROM sized JOIN totals USING (conv_id) GROUP BY conv_id
"""


@register("op5_chat", CHAT_SQL)
def op5_chat(spark, sf_dir) -> DataFrame:
    """What the training windows of every conversation hold, read back from their text."""
    said = "<|im_end|><|im_start|>assistant ok"
    extra = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"),
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    shown = chat.windows(rows.unionByName(extra))
    turns = chat.read_turns(F.col("formatted"))
    fresh = F.slice(turns, F.col("repeated") + 1, F.greatest(F.size(turns) - F.col("repeated"), F.lit(0)))
    read = shown.select(
        "conv_id", "window",
        F.size(fresh).alias("turns"),
        F.concat_ws("", F.transform(fresh, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))).alias("said"),
        F.concat_ws("", chat.read_targets(F.col("formatted"), F.col("loss_spans"))).alias("loss"),
        F.length("formatted").alias("chars"),
    )
    # The digest of a whole conversation needs its text in one row.
    whole = F.sort_array(F.collect_list(F.struct("window", "said", "loss")))
    joined = read.groupBy("conv_id").agg(
        F.sum("turns").alias("n_turns"), F.sum("chars").alias("formatted_chars"), whole.alias("parts")
    )
    loss = F.concat_ws("", "parts.loss")
    return joined.select(
        "conv_id", "n_turns", sha256(F.concat_ws("", "parts.said")).alias("turns_sha256"),
        F.length(loss).cast("bigint").alias("loss_chars"), sha256(loss).alias("loss_sha256"), "formatted_chars",
    )


def _license_sql() -> str:
    """The same notices by comparing every window with every template, without bands."""
    values = ", ".join(f"('{name}', '{text.replace(chr(39), chr(39) * 2)}')" for name, text in sorted(licenses.TEMPLATES.items()))
    words = f"regexp_extract_all(lower(text), '{licenses.WORD}')"
    run = " || ' ' || ".join(f"words[i + {n}]" for n in range(licenses.SHINGLE_WORDS))
    return rf"""
WITH templates(license, text) AS (VALUES {values}),
template_words AS (SELECT license, {words} AS words FROM templates),
owned AS (
  SELECT DISTINCT license, {run} AS shingle
  FROM (SELECT license, words, unnest(range(1, len(words) - {licenses.SHINGLE_WORDS - 2})) AS i FROM template_words)
), sizes AS (
  SELECT license, count(*) AS size, ceil(log2(count(*)))::INTEGER AS class FROM owned GROUP BY 1
), layouts AS (
  SELECT class, ceil(max(size) / 2)::BIGINT AS step, max(size) + ceil(max(size) / 2)::BIGINT AS width FROM sizes GROUP BY 1
), doc_words AS (SELECT doc_id, {words} AS words FROM documents),
hits AS (
  SELECT doc_id, license, i - 1 AS i, shingle FROM (
    SELECT doc_id, i, {run} AS shingle
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - {licenses.SHINGLE_WORDS - 2})) AS i FROM doc_words)
  ) JOIN owned USING (shingle)
), placed AS (
  SELECT doc_id, license, i, shingle, step,
    unnest(range(greatest(0, (i - width + step) // step), i // step + 1)) AS part
  FROM hits JOIN sizes USING (license) JOIN layouts USING (class)
), held AS (
  SELECT doc_id, license, part, count(DISTINCT shingle) / any_value(size) AS containment,
    min(i) AS first_word, max(i) + {licenses.SHINGLE_WORDS - 1} AS last_word
  FROM placed JOIN sizes USING (license) GROUP BY 1, 2, 3
)
SELECT doc_id, license, containment, first_word, last_word FROM held WHERE containment >= {licenses.CONTAINMENT}
QUALIFY row_number() OVER (PARTITION BY doc_id, license ORDER BY containment DESC, part) = 1
"""


@register("op9_licenses", _license_sql())
def op9_licenses(spark, sf_dir) -> DataFrame:
    """The license notices in every document."""
    return licenses.scan(table(spark, sf_dir, "documents"))


@register("op8_epsilon_grid")
def op8_epsilon_grid(spark, sf_dir) -> DataFrame:
    """Links and near-duplicate component of every embedding."""
    return epsilon_grid.near_vectors(table(spark, sf_dir, "embeddings"))


#: The mixture of the queries: weights of the nodes of each level, budget as a share of all tokens.
DOMAINS = 4
MIX_WEIGHTS = ({"d0": 4, "d1": 2}, {"en": 2, "fr": 3}, {"src0": 2, "src1": 5})
MIX_SHARE, MIX_EPOCHS = 0.8, 3


def mix_levels() -> dict[str, Column]:
    """Domain (from the number of the source), language and source."""
    number = F.regexp_extract("source", "([0-9]+)$", 1)
    domain = F.when(number != "", F.concat(F.lit("d"), number.cast("bigint") % DOMAINS))
    return {"domain": domain, "lang": F.col("lang"), "source": F.col("source")}


def _mix_sql() -> str:
    """The same mixture with one window over every leaf."""
    names = ["domain", "lang", "source"]
    ctes, parents = [], []
    for depth, name in enumerate(names):
        path = names[: depth + 1]
        cases = " ".join(f"WHEN {name} = '{k}' THEN {float(v)}" for k, v in MIX_WEIGHTS[depth].items())
        of = ", ".join(path)
        group = f"PARTITION BY {', '.join(parents)}" if parents else ""
        budget = f"JOIN granted{depth - 1} USING ({', '.join(parents)})" if parents else "CROSS JOIN total"
        ctes.append(f"""
nodes{depth} AS (
  SELECT *, CASE {cases} ELSE 1.0 END::DOUBLE AS weight
  FROM (SELECT {of}, sum(tokens)::BIGINT * {MIX_EPOCHS} AS capacity FROM rows GROUP BY ALL) {budget}
), stands{depth} AS (
  SELECT *, (budget - coalesce(sum(capacity) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS stand
  FROM nodes{depth} WINDOW w AS ({group} ORDER BY capacity / weight, {of})
), granted{depth} AS (
  SELECT {of}, greatest(least(capacity::DOUBLE, max(stand) OVER ({group}) * weight), 0.0) AS budget FROM stands{depth}
)""")
        parents = path
    return f"""
WITH rows AS (
  SELECT doc_id, coalesce(CASE WHEN regexp_matches(source, '[0-9]+$')
      THEN 'd' || (regexp_extract(source, '([0-9]+)$', 1)::BIGINT % {DOMAINS}) END, '?') AS domain,
    coalesce(lang, '?') AS lang, coalesce(source, '?') AS source,
    greatest(ceil(length(coalesce(text, '')) / {mixing.CHARS_PER_TOKEN}), 1)::BIGINT AS tokens
  FROM documents
), total AS (SELECT floor(sum(tokens) * {MIX_SHARE}::DOUBLE)::DOUBLE AS budget FROM rows), {",".join(ctes)},
leaves AS (
  SELECT domain, lang, source, sum(tokens)::BIGINT AS size FROM rows GROUP BY ALL
), quotas AS (
  SELECT *, least(floor(budget / size), {MIX_EPOCHS})::BIGINT AS full_epochs FROM leaves JOIN granted2 USING (domain, lang, source)
), hashed AS (
  SELECT *, md5('{mixing.SEED}:' || full_epochs || ':' || coalesce(doc_id::VARCHAR, '?')) AS hash
  FROM rows JOIN quotas USING (domain, lang, source)
), spent AS (
  SELECT *, sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY hash, doc_id) AS spent FROM hashed
), taken AS (
  SELECT *, full_epochs + (CASE WHEN full_epochs < {MIX_EPOCHS} AND spent <= floor(budget) - full_epochs * size
    THEN 1 ELSE 0 END) AS copies FROM spent
)
SELECT doc_id, domain, lang, source, tokens, copies::BIGINT AS copies FROM taken WHERE copies > 0
"""


@register("op2_mixing", _mix_sql())
def op2_mixing(spark, sf_dir) -> DataFrame:
    """The documents that the mixture takes, and how often."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    taken = mixing.mix(docs, mix_levels(), MIX_WEIGHTS, MIX_SHARE, MIX_EPOCHS)
    levels = [F.coalesce(c.cast("string"), F.lit("?")).alias(n) for n, c in mix_levels().items()]
    return taken.select("doc_id", *levels, mixing.token_count("text").alias("tokens"), "copies")


#: Queries of the searches by vector: rows whose id this divides.
QUERY_STEP, TOP_VECTORS, VECTOR_SCALE = 100, 10, 1024

TOPK_SQL = f"""
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor({VECTOR_SCALE} * x::DOUBLE)::BIGINT::DOUBLE) AS e FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
)
SELECT q.vec_id AS query_id, row_number() OVER (PARTITION BY q.vec_id ORDER BY list_inner_product(q.e, c.e) DESC, c.vec_id)::INTEGER AS rank,
  c.vec_id AS vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
FROM whole q JOIN whole c ON q.vec_id % {QUERY_STEP} = 0 AND q.vec_id <> c.vec_id
QUALIFY rank <= {TOP_VECTORS}
"""


@register("op11_topk", TOPK_SQL)
def op11_topk(spark, sf_dir) -> DataFrame:
    """The most similar embeddings of every hundredth one."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % QUERY_STEP == 0, TOP_VECTORS, scale=VECTOR_SCALE)


_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

LEXICAL_SQL = f"""
WITH docs AS (
  SELECT row_number() OVER () AS d, doc_id, regexp_extract_all({_LOWERED}, '{_TERM}') AS words FROM documents
), whole AS (SELECT * FROM docs WHERE len(words) > 0),
totals AS (SELECT count(*)::BIGINT AS big_n, sum(len(words))::BIGINT AS big_l FROM whole),
asked AS (
  SELECT item_id, term, count(*)::BIGINT AS repeats
  FROM (SELECT item_id, unnest(regexp_extract_all({_LOWERED}, '{_TERM}')) AS term FROM benchmark) GROUP BY ALL
), counted AS (
  SELECT d, term, count(*)::BIGINT AS tf
  FROM (SELECT d, unnest(words) AS term FROM whole) WHERE term IN (SELECT term FROM asked) GROUP BY ALL
), weights AS (
  SELECT term, floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM counted, totals GROUP BY term, big_n
), impacts AS (
  SELECT d, doc_id, term, (1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * len(words) * big_n) // big_l)) AS impact
  FROM counted JOIN whole USING (d), totals
), scores AS (
  SELECT item_id, d, doc_id, sum(repeats * w * impact)::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN impacts USING (term) GROUP BY ALL
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= {lexical.TOP}
"""


@register("op12_lexical", LEXICAL_SQL)
def op12_lexical(spark, sf_dir) -> DataFrame:
    """The best documents of every benchmark item."""
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op13_spelling")
def op13_spelling(spark, sf_dir) -> DataFrame:
    """The frequent words with their commoner spellings."""
    return spelling.variants(table(spark, sf_dir, "documents"))
