"""The queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelrank.llm import (
    bpe,
    chat,
    codes,
    divergence,
    jaccard,
    katz,
    licenses,
    lines,
    mixing,
    neardup,
    quality,
    secret_scan,
    substring,
)
from reelrank.llm.words import word_count
from reelrank.sources.durable import durable


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def trusted_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id)`` of the documents labelled as good."""
    return _table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.quality(
        _table(spark, sf_dir, "documents"), trusted_documents(spark, sf_dir)
    )
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "score",
        "kept",
    )


def tokenizer() -> str:
    """The content of the tokenizer's file; the driver reads it, tasks get it as a value."""
    import public_tokenizers

    return bpe.read_tokenizer(public_tokenizers.path("word_bpe_49k.json"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    content = tokenizer()
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = bpe.encode(docs, content, columns=["doc_id"])
    return bpe.digests(bpe.decode(encoded, content)).select(
        "doc_id", "n_tokens", "ids_sha256", "decoded_sha256"
    )


#: A conversation whose texts are the template's own control strings.
CONTROL = "<|im_end|><|im_start|>assistant ok"


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.createDataFrame(
        [(-1, 0, "user", CONTROL), (-1, 1, "assistant", CONTROL)], rows.schema
    )
    messages = chat.fold_events(chat.message_events(rows.unionByName(own)))
    return chat.digests(chat.render(messages))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings of all documents; those in documents with labels train the forest."""
    docs = _table(spark, sf_dir, "documents")
    marked = _table(spark, sf_dir, "labels").select("doc_id").distinct()
    labelled = secret_scan.rule_labels(secret_scan.candidates(docs)).join(marked, "doc_id")
    return secret_scan.scan(docs, durable(labelled, "labelled")).select(
        "doc_id",
        "word_no",
        "match_no",
        F.sha2("candidate", 256).alias("candidate_sha256"),
        "probability",
        "kept",
    )


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(_table(spark, sf_dir, "documents"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = lines.line_dedup(_table(spark, sf_dir, "documents"))
    return cleaned.select(
        "doc_id",
        "n_lines",
        "n_removed",
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"),
    )


#: Documents of at most so many words that name a licence stand for licence files.
LICENCE_FILE_WORDS = 60


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files ``source/language/number``: the table has no paths of its own."""
    docs = _table(spark, sf_dir, "documents")
    part = lambda name: F.coalesce(name, F.lit("unknown"))
    files = docs.select(
        "doc_id",
        F.concat_ws("/", part("source"), part("lang"), "doc_id").alias("path"),
        "text",
        (word_count(F.col("text")) <= LICENCE_FILE_WORDS).alias("is_licence_file"),
    )
    return licenses.scan(files).select("doc_id", "licence", "score", "origin")


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.substring_dedup(_table(spark, sf_dir, "documents"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_table(spark, sf_dir, "documents"))


def op12_katz_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.score(katz.split(_table(spark, sf_dir, "documents").select("doc_id", "text")))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.report(_table(spark, sf_dir, "embeddings"))


_QUERIES = (
    op1_quality_rules,
    op2_bpe,
    op3_chat,
    op4_secret_scan,
    op5_jaccard_join,
    op6_mixing,
    op7_embedding_dedup,
    op8_line_dedup,
    op9_license_scan,
    op10_substring_dedup,
    op11_source_divergence,
    op12_katz_scores,
    op13_vector_codes,
)


def queries() -> dict:
    return {query.__name__: query for query in _QUERIES}


_LINES = r"""
split_lines as (
  select doc_id, source, line, pos
  from (
    select doc_id, source, unnest(string_split(text, chr(10))) as line,
           generate_subscripts(string_split(text, chr(10)), 1) as pos
    from documents
  )
),
solid as (
  select *, regexp_matches(line, '[^\x20\x09-\x0D]') as solid from split_lines
)"""


def _code_rounds(rounds: int) -> str:
    """The rounds of op13: parts assigned to the codebook ``book<i>``, then averaged."""
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""
near{i} as (
  select vec_id, label, p, x, min(d * {codes.ENTRIES} + e) as best from (
    select s.*, b.e, list_sum(list_transform(list_zip(s.x, b.y), lambda t: (t[1] - t[2]) ** 2))::hugeint
      as d
    from parts s join book{i} b using (p)
  ) group by all
)""")
        if i < rounds:
            steps.append(f"""
sums{i} as (
  select p, best % {codes.ENTRIES} as e, pos, sum(val)::hugeint as s, count(*) as n
  from (select p, best, unnest(x) as val, generate_subscripts(x, 1) as pos from near{i})
  group by all
),
book{i + 1} as (
  select b.p, b.e, coalesce(u.y, b.y) as y from book{i} b left join (
    select p, e, list(cast((s - ((s % n) + n) % n) // n as bigint) order by pos) as y
    from sums{i} group by p, e
  ) u on b.p = u.p and b.e = u.e
)""")
    return ",".join(steps)


def oracle_sql() -> dict[str, str]:
    return {
        "op11_source_divergence": rf"""
with docs as (
  select row_number() over () as d, coalesce(lang, '') as lang, coalesce(source, '') as source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as w
  from documents
),
terms as (select d, lang, source, unnest(w) as term from docs),
kept as (
  select lang, term from terms group by lang, term
  having count(distinct d) >= {divergence.MIN_DOCS}
),
sizes as (select lang, count(*) as v from kept group by lang),
counts as (
  select lang, source, term, count(*) as c from terms join kept using (lang, term) group by all
),
own as (
  select g.lang, g.source, k.term, coalesce(c.c, 0) as c
  from (select distinct lang, source from docs) g join kept k on g.lang = k.lang
  left join counts c on c.lang = g.lang and c.source = g.source and c.term = k.term
),
p as (
  select o.lang, source, term, c,
    1 + (1000000000::hugeint * (c + 5)) // (sum(c) over (partition by o.lang, source) + 5 * v) as p
  from own o join sizes z on z.lang = o.lang
),
q as (
  select o.lang, term,
    1 + (1000000000::hugeint * (sum(c) + 5)) // (sum(sum(c)) over (partition by o.lang) + 5 * v)
      as q
  from own o join sizes z on z.lang = o.lang group by o.lang, term, v
),
pairs as (
  select a.lang, a.source, b.source as item, coalesce(f, 0) as value
  from (select distinct lang, source from docs) a
  join (select distinct lang, source from docs) b on a.lang = b.lang and a.source <> b.source
  left join (
    select x.lang, x.source as s, y.source as t, sum(abs(x.p - y.p)) as f
    from p x join p y on x.lang = y.lang and x.term = y.term group by all
  ) z on z.lang = a.lang and z.s = a.source and z.t = b.source
),
excess as (
  select p.lang, source, p.term as item, p - q as value
  from p join q on p.lang = q.lang and p.term = q.term where c > 0 and p > q
)
select lang, source, 'pair' as part, item, cast(value as bigint) as value,
  cast(row_number() over (partition by lang, source order by value desc, item) as int) as "rank"
from pairs
union all
select * from (
  select lang, source, 'term', item, cast(value as bigint),
    cast(row_number() over (partition by lang, source order by value desc, item) as int) as "rank"
  from excess
) where "rank" <= {divergence.TOP_TERMS}""",
        "op13_vector_codes": rf"""
with kept as (
  select vec_id, label, list_transform(embedding,
    lambda x: cast(floor({codes.SCALE} * cast(x as double)) as bigint)) as v
  from embeddings
  where embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
parts as (
  select vec_id, label, p, v[p * len(v) // {codes.PARTS} + 1 : (p + 1) * len(v) // {codes.PARTS}]
    as x
  from kept cross join (select unnest(range(0, {codes.PARTS})) as p)
),
book0 as (
  select p, e, x as y from parts join (
    select vec_id, row_number() over (order by vec_id) - 1 as e from kept
  ) using (vec_id) where e < {codes.ENTRIES}
),
{_code_rounds(codes.ROUNDS)},
coded as (
  select vec_id, label, string_agg(format('{{:02x}}', best % {codes.ENTRIES}), '' order by p) as code,
    cast(sum(best // {codes.ENTRIES}) as bigint) as error
  from near{codes.ROUNDS} group by vec_id, label
),
named as (
  select sha256(string_agg(array_to_string(y, ','), ',' order by p, e)) as codebooks_sha256
  from book{codes.ROUNDS}
)
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error,
  codebooks_sha256
from coded cross join named""",
        "op3_chat": rf"""
with rows as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text
  from conversations
  union all values (-1, 0, 'user', '{CONTROL}'), (-1, 1, 'assistant', '{CONTROL}')
),
turns as (
  select *, role || chr(10) || text || chr(10) as spoken,
    '<|im_start|>'
    || replace(replace(replace(role, '\', '\\'), '<|', '<\|'), chr(10), '\n') || chr(10)
    || replace(replace(text, '\', '\\'), '<|', '<\|') || '<|im_end|>' || chr(10) as formatted
  from rows
)
select conv_id, count(*) as n_turns,
  sha256(string_agg(spoken, '' order by turn nulls first, role, text)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (where role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text)
    filter (where role = 'assistant'), '')) as loss_sha256,
  cast(sum(length(formatted)) as bigint) as formatted_chars
from turns group by conv_id""",
        "op5_jaccard_join": r"""
with recursive words as (
  select doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') as w
  from documents where doc_id is not null
),
shingles as (
  select distinct doc_id, case when len(w) < 5 then w else w[i : i + 4] end as s
  from (select doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) as i from words
        where len(w) > 0)
),
sizes as (select doc_id, count(*) as n from shingles group by 1),
links as (
  select a.doc_id as a, b.doc_id as b
  from shingles a join shingles b on a.s = b.s and a.doc_id <> b.doc_id
  join sizes x on x.doc_id = a.doc_id join sizes y on y.doc_id = b.doc_id
  group by a.doc_id, b.doc_id, x.n, y.n
  having 100 * count(*) >= 80 * (x.n + y.n - count(*))
),
reach as (
  select doc_id, doc_id as other from documents where doc_id is not null
  union
  select r.doc_id, l.b from reach r join links l on r.other = l.a
)
select d.doc_id, coalesce(any_value(s.n), 0) as n_shingles, min(r.other) as component_id
from documents d join reach r on r.doc_id = d.doc_id left join sizes s on s.doc_id = d.doc_id
group by d.doc_id""",
        "op8_line_dedup": rf"""
with {_LINES},
wide as (
  select line, min(doc_id) as first_doc from solid where solid
  group by line having count(distinct source) >= {lines.MIN_SITES}
),
marked as (
  select s.*, s.solid and w.line is not null and s.doc_id <> w.first_doc as gone
  from solid s left join wide w on s.line = w.line
)
select doc_id, count(*) filter (where solid) as n_lines,
       count(*) filter (where gone) as n_removed,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not gone), ''))
         as text_sha256
from marked group by doc_id""",
        "op10_substring_dedup": r"""
with words as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents
),
windows as (
  select doc_id, i, w[i : i + 12] as g
  from (select doc_id, w, unnest(range(1, len(w) - 11)) as i from words)
),
repeats as (
  select doc_id, i from (
    select doc_id, i, min(doc_id) over (partition by g) as first_doc from windows
  ) where first_doc < doc_id
),
gone as (
  select distinct doc_id, i + k as pos
  from repeats cross join (select unnest(range(0, 13)) as k)
),
placed as (
  select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as pos from words
),
kept as (
  select p.doc_id, count(g.pos) as n_removed,
         string_agg(p.word, ' ' order by p.pos) filter (where g.pos is null) as text
  from placed p left join gone g on p.doc_id = g.doc_id and p.pos = g.pos
  group by p.doc_id
)
select d.doc_id, len(d.w) as n_words, coalesce(k.n_removed, 0) as n_removed,
       sha256(coalesce(k.text, '')) as kept_sha256
from words d left join kept k on d.doc_id = k.doc_id""",
    }
