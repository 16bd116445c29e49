"""All queries over the engine's own operators and their SQL counterparts. Each runs over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions import pyast, textfn
from corpusmill.operators import chat, fim, instruct, outliers, quality, synth
from corpusmill.plans import rendered
from corpusmill.runtime import materialize, scratch, table
from corpusmill.sources import html, jsonl, sinks

SEED = 42
EXAMPLES = 15_000
PAIRS = 80_000


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "source_docs").select("file_id", "doc_id", "content")


def _files(spark: SparkSession, d: str) -> DataFrame:
    """Python files only."""
    return table(spark, d, "source_docs").where(F.col("file_path").endswith(".py")).select("file_id", "content")


def _corpus(spark: SparkSession, d: str) -> DataFrame:
    return rendered.code_corpus(table(spark, d, "part"))


def _triples(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "fim_triples").select("triple_id", "prefix_code", "target_code", "suffix_code")


def _chats(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "chat_records").select("record_id", "messages")


def _features(spark: SparkSession, d: str) -> DataFrame:
    """Whole numbers from the documents' texts, so that distances are exact in any engine."""
    t = F.col("text")
    return table(spark, d, "documents").where(t.isNotNull()).select(
        "doc_id",
        F.length(t).cast("double").alias("f1"),
        F.length(F.regexp_replace(t, "[^0-9]", "")).cast("double").alias("f2"),
        F.length(F.regexp_replace(t, "[^A-Z]", "")).cast("double").alias("f3"),
        F.length(F.regexp_replace(t, "[^\\n]", "")).cast("double").alias("f4"),
    )


def _json_lines(spark: SparkSession, d: str) -> DataFrame:
    """Triples as JSON lines, some of them cut."""
    t = _triples(spark, d)
    line = F.to_json(F.struct("prefix_code", "target_code", "suffix_code"), {"ignoreNullFields": "false"})
    return t.select(F.col("triple_id").alias("line_no"), F.when(F.col("triple_id") % 7 == 0, F.substring(line, 2, 1 << 30)).otherwise(line).alias("value"))


def _personas(spark: SparkSession) -> DataFrame:
    rows = [({"role_context": f"You are a {r}.", "tone_context": t, "task_instruction": "Complete the code.", "output_requirement": m},) for r in ("teacher", "reviewer") for t in ("Be brief.", "Be kind.") for m, _ in synth.ADDITIONS]
    return spark.createDataFrame([*rows, ({"role_context": "Ein Prüfer."},)], "persona map<string,string>")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "rule1_clean": lambda s, d: quality.drop_empty(_docs(s, d)).select("file_id", "original_content_length"),
        "dedup_content": lambda s, d: quality.first_of_each(quality.drop_empty(_docs(s, d)), ["content"], "file_id").select("file_id"),
        "text_metrics": lambda s, d: quality.text_metrics(_docs(s, d)).select("file_id", F.round("special_ratio", 10).alias("special_ratio"), "content_length", "number_of_lines", F.round("comment_ratio", 10).alias("comment_ratio")),
        "remove_comments": lambda s, d: _docs(s, d).select("file_id", F.md5(textfn.remove_comments("content")).alias("clean_md5")),
        "min_len_filter": lambda s, d: quality.text_metrics(_docs(s, d)).where("content_length >= 10").select("file_id", "content_length"),
        "license_filter": lambda s, d: _docs(s, d).where(F.col("content").isNotNull() & ~instruct.licence_chunk(F.col("content"))).select("file_id"),
        "allowed_text": lambda s, d: _docs(s, d).select("file_id", textfn.only_allowed_characters("content").alias("allowed")),
        "unescape_project": lambda s, d: chat.projected_content(_docs(s, d), "file_id").select("file_id", F.md5("content").alias("content_md5")),
        "quality_labels": lambda s, d: quality.labelled(_files(s, d), "file_id").drop("content", "clean_content"),
        "corpus_labels": lambda s, d: quality.labelled(_corpus(s, d), "doc_id").select("doc_id", "is_syntax_error", "cyclomatic_complexity", "number_of_lines", "label", F.round("maintainability_index", 8).alias("maintainability_index")),
        "quality_pipeline": lambda s, d: quality.pipeline(_files(s, d), "file_id").select("file_id", "label", "removed_by"),
        "stage_counts": lambda s, d: quality.stage_report(_corpus(s, d).withColumn("content", F.when(F.col("doc_id") % 9 == 0, F.concat(F.lit("x = "), (F.col("doc_id") % 5).cast("string"))).when(F.col("doc_id") % 13 == 0, F.lit("")).otherwise(F.col("content"))), "doc_id"),
        "union_bad": lambda s, d: _bad_union(s, d),
        "removed_rows": lambda s, d: quality.without(_docs(s, d), quality.first_of_each(_docs(s, d), ["content"], "file_id"), "file_id").select("file_id"),
        "code_structure": lambda s, d: _structure(_corpus(s, d)),
        "file_structure": lambda s, d: quality.with_code_metrics(_files(s, d).withColumn("clean_content", textfn.remove_comments("content"))).drop("content", "clean_content"),
        "valid_python": lambda s, d: _corpus(s, d).select("doc_id", pyast.is_valid_python(F.col("content")).alias("is_valid")),
        "short_fim": lambda s, d: fim.statement_triples(_corpus(s, d), "doc_id"),
        "short_fim_files": lambda s, d: fim.statement_triples(_files(s, d), "file_id"),
        "long_fim": lambda s, d: fim.function_triples(_corpus(s, d), "doc_id"),
        "long_fim_files": lambda s, d: fim.function_triples(_files(s, d), "file_id"),
        "import_move": lambda s, d: fim.move_imports(_triples(s, d)),
        "fim_chat_render": lambda s, d: fim.chat_form(_triples(s, d)).select("triple_id", F.element_at("messages", 1)["content"].alias("ask"), F.element_at("messages", 2)["content"].alias("answer")),
        "merge_unique": lambda s, d: chat.merge_unique(_triples(s, d), "triple_id"),
        "merge_all": lambda s, d: chat.merge_all(_triples(s, d).where("triple_id % 2 = 0"), _triples(s, d).where("triple_id % 2 = 1")),
        "valid_lines": lambda s, d: jsonl.valid_lines(_json_lines(s, d)).select("line_no"),
        "policy_records": lambda s, d: jsonl.records(_json_lines(s, d), list(chat.TRIPLE), jsonl.POLICIES["unique_merge"]).select("line_no", *chat.TRIPLE),
        **{f"policy_{name}": lambda s, d, name=name: _policy(s, d, name) for name in jsonl.POLICIES},
        "jsonl_roundtrip": lambda s, d: _jsonl_roundtrip(s, d),
        "ascii_lines": lambda s, d: _ascii_lines(s, d),
        "table_roundtrip": lambda s, d: _table_roundtrip(s, d),
        "batch_roundtrip": lambda s, d: _batch_roundtrip(s, d),
        "log_roundtrip": lambda s, d: _log_roundtrip(s, d),
        "persona_file": lambda s, d: _persona_file(s),
        "documents_scan": lambda s, d: jsonl.documents(s, f"{d}/source_docs.parquet", where="n_bytes > 1000", drop=("content", "_id", "crawled_at", "ingested_at", "file_lang")),
        "anti_processed": lambda s, d: instruct.unprocessed(_docs(s, d), table(s, d, "chat_records").select("doc_id"), "doc_id").select("file_id", "doc_id"),
        "newest_unprocessed": lambda s, d: instruct.newest(instruct.unprocessed(_docs(s, d), table(s, d, "chat_records").select("doc_id"), "doc_id"), "file_id", 100).select("file_id"),
        "dialogue_pretty": lambda s, d: chat.pretty_dialogues(_chats(s, d), "record_id"),
        "assistant_code_blocks": lambda s, d: chat.assistant_code(_chats(s, d), "record_id"),
        "spacing_normalize": lambda s, d: chat.turns(chat.normalized_spacing(_chats(s, d)), "record_id"),
        "chat_turns": lambda s, d: chat.turns(_chats(s, d), "record_id"),
        "chat_regroup": lambda s, d: chat.regrouped(chat.turns(_chats(s, d), "record_id"), "record_id").select("record_id", F.size("messages").alias("n_turns"), F.md5(F.array_join(F.transform("messages", lambda m: F.coalesce(m["content"], F.lit("<null>"))), "|")).alias("joined_md5")),
        "fn_chunks": lambda s, d: instruct.function_chunks(_corpus(s, d), "doc_id"),
        "fn_chunks_files": lambda s, d: instruct.function_chunks(_files(s, d), "file_id"),
        "fn_chunks_odd": lambda s, d: instruct.function_chunks(rendered.odd_files(table(s, d, "part")), "doc_id"),
        "cleaned_answers": lambda s, d: rendered.answers(table(s, d, "part")).select("p_partkey", pyast.cleaned_answer("answer").alias("answer")),
        "instructions_function": lambda s, d: instruct.function_instructions(_corpus(s, d), "doc_id").select("doc_id", "idx", F.element_at("messages", 1)["content"].alias("instruction"), F.element_at("messages", 2)["content"].alias("code")),
        "instructions_document": lambda s, d: instruct.document_instructions(_files(s, d), "file_id").select("file_id", F.element_at("messages", 1)["content"].alias("instruction")),
        "page_headings": lambda s, d: _page(s, d, lambda t: html.headings(t, ("h2",)), "headings"),
        "page_headings_wide": lambda s, d: _page(s, d, lambda t: html.headings(t, ("h2", "h3"), ""), "headings"),
        "page_definitions": lambda s, d: _page(s, d, html.definitions, "definitions"),
        "page_header_table": lambda s, d: _page(s, d, lambda t: html.header_table(t, rendered.MAIN_TABLE), "tables"),
        "page_cell_table": lambda s, d: _page(s, d, lambda t: html.cell_table(t, rendered.MAIN_TABLE), "tables"),
        "error_examples": lambda s, d: synth.error_examples(s, EXAMPLES, SEED).select("id", "kind", "error_context.*", "fixed_code_snippet"),
        "error_kinds": lambda s, d: synth.error_examples(s, EXAMPLES, SEED).groupBy("kind").agg(F.count("*").alias("n_examples")),
        "persona_pairs": lambda s, d: synth.persona_pairs(_files(s, d), _personas(s), PAIRS, "file_id").select("id", F.element_at("messages", 1)["content"].alias("system"), F.element_at("messages", 2)["content"].alias("ask"), F.element_at("messages", 3)["content"].alias("answer")),
        "persona_filter": lambda s, d: synth.allowed_personas(_personas(s)).select(synth.system_turn(F.col("persona")).alias("system")),
        "isolation_filter": lambda s, d: outliers.isolation_forest(_labelled_features(_files(s, d), "file_id"), "file_id", quality.FEATURES).select("file_id", "iso_score", "is_outlier"),
        "lof_features": lambda s, d: outliers.local_outlier_factor(_labelled_features(_corpus(s, d), "doc_id"), "doc_id", quality.FEATURES).select("doc_id", F.round(F.log("lof"), 6).alias("log_lof"), "is_outlier"),
        "lof_filter": lambda s, d: outliers.local_outlier_factor(_features(s, d), "doc_id", ("f1", "f2", "f3", "f4")).select("doc_id", F.round("lof", 6).alias("lof"), "is_outlier"),
    }


def _labelled_features(df: DataFrame, key: str) -> DataFrame:
    """The pipeline's four features of well labelled rows, rounded so that any engine has the same numbers."""
    rows = quality.labelled(df, key).where("label = 1").select(key, *(F.round(F.col(f).cast("double"), 6).alias(f) for f in quality.FEATURES))
    return materialize(rows, "features")  # the outlier filters read them several times


def _bad_union(spark: SparkSession, d: str) -> DataFrame:
    """Rows that the rules label bad, and outliers among the others (here by a plain bound), as the pipeline puts them together."""
    rows = quality.labelled(_corpus(spark, d), "doc_id")
    marks = F.when(F.col("label") == 0, "rules").when(F.col("cyclomatic_complexity") >= 7, "outlier")
    marked = rows.withColumn("removed_by", marks)
    by_rules, outlying = marked.where("removed_by = 'rules'"), marked.where("removed_by = 'outlier'")
    return quality.union_of_sets(by_rules.select("doc_id", "removed_by"), outlying.select("doc_id", "removed_by", "cyclomatic_complexity"))


def _odd_lines(spark: SparkSession, d: str) -> DataFrame:
    """Triples as lines, by ``line_no % 7``: cut JSON, blank, a missing field, a number instead of text, otherwise sound."""
    t = _triples(spark, d)
    kind = F.col("triple_id") % 7
    whole = F.to_json(F.struct("prefix_code", "target_code", "suffix_code"), {"ignoreNullFields": "false"})
    line = (
        F.when(kind == 0, F.substring(whole, 2, 1 << 30)).when(kind == 1, F.lit("  ")).when(kind == 2, F.to_json(F.struct("prefix_code"), {"ignoreNullFields": "false"}))
        .when(kind == 3, F.to_json(F.struct("prefix_code", F.lit(5).alias("target_code"), "suffix_code"), {"ignoreNullFields": "false"})).otherwise(whole)
    )
    return t.select(F.col("triple_id").alias("line_no"), kind.alias("kind"), line.alias("value"))


ODD_KINDS = ("invalid", "blank", "missing", "wrong_type")


def _policy(spark: SparkSession, d: str, name: str) -> DataFrame:
    """What a policy makes of each kind of line; kinds that it ends the read at are left out (tests cover the error)."""
    policy = jsonl.POLICIES[name]
    ends = [i for i, k in enumerate(ODD_KINDS) if getattr(policy, k) == "fail"]
    rows = _odd_lines(spark, d).where(~F.col("kind").isin(ends)) if ends else _odd_lines(spark, d)
    return jsonl.records(rows, list(chat.TRIPLE), policy).select("line_no", *chat.TRIPLE, "problem")


def _policy_sql(name: str) -> str:
    policy = jsonl.POLICIES[name]
    acts = [getattr(policy, k) for k in ODD_KINDS]
    gone = ", ".join(str(i) for i, a in enumerate(acts) if a in ("skip", "fail"))
    empty = "''" if acts[2] == "empty" else "NULL"
    return f"""
        SELECT triple_id AS line_no, CASE WHEN triple_id % 7 < 2 THEN NULL ELSE prefix_code END AS prefix_code,
               CASE WHEN triple_id % 7 = 2 THEN {empty} WHEN triple_id % 7 < 4 THEN NULL ELSE target_code END AS target_code,
               CASE WHEN triple_id % 7 = 2 THEN {empty} WHEN triple_id % 7 < 2 THEN NULL ELSE suffix_code END AS suffix_code,
               CASE triple_id % 7 WHEN 0 THEN 'invalid JSON' WHEN 1 THEN 'blank line' WHEN 2 THEN {"NULL" if acts[2] == "empty" else "'no suffix_code'"} WHEN 3 THEN 'target_code is no text' END AS problem
        FROM fim_triples WHERE triple_id % 7 NOT IN ({gone or -1})"""


def _jsonl_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "lines")
    sinks.write_jsonl(_triples(spark, d), path, single_order="triple_id")
    return jsonl.records(jsonl.lines(spark, path).withColumn("line_no", F.get_json_object("value", "$.triple_id").cast("long")), list(chat.TRIPLE), jsonl.POLICIES["long_fim"]).select("line_no", *chat.TRIPLE)


def _ascii_lines(spark: SparkSession, d: str) -> DataFrame:
    """Chat turns written in ASCII only and read again."""
    path = scratch(spark, "ascii")
    sinks.write_jsonl(chat.turns(_chats(spark, d), "record_id"), path, ascii_only=True)
    line = spark.read.text(path)
    read = F.from_json("value", "record_id bigint, turn int, role string, content string")
    return line.select((~F.col("value").rlike("[^\\x00-\\x7F]")).alias("is_ascii"), read.alias("r")).select("is_ascii", "r.*")


def _table_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Two appends of orders, with an internal id that isn't written and not-a-number in place of every fifth price."""
    path = scratch(spark, "table")
    o = table(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 5 == 0, F.lit(float("nan"))).otherwise(F.col("o_totalprice")).alias("price"), F.lit("internal").alias("_id"))
    for half in (0, 1):
        sinks.write_table(o.where(F.col("o_orderkey") % 2 == half), path)
    sinks.write_table(o.limit(0), path)
    return spark.read.parquet(path)


def _batch_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Processed ids and records of two batches, one of them replayed, and of a third that broke off before its commit."""
    path = scratch(spark, "batches")
    docs = _docs(spark, d).select("file_id")
    for number in (0, 1, 1):
        part = docs.where(F.col("file_id") % 3 == number)
        sinks.write_batch(part.withColumn("batch_no", F.lit(number)), part, path, number)
    docs.where("file_id % 3 = 2").write.json(f"{path}/records/batch=2")
    records = sinks.batch_records(spark, path, "file_id bigint, batch_no int")
    return records.join(sinks.batch_ids(spark, path).select(F.col("id").cast("long").alias("file_id")), "file_id")


def _log_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "log")
    sinks.write_text(table(spark, d, "chat_records").select(F.concat(F.lit(" "), F.coalesce("doc_id", F.lit("")), F.lit(" ")).alias("value")), path)
    return jsonl.processed_log(spark, path)


def _persona_file(spark: SparkSession) -> DataFrame:
    path = scratch(spark, "personas")
    sinks.write_text(_personas(spark).coalesce(1).agg(F.to_json(F.struct(F.collect_list("persona").alias("personas"))).alias("value")), path)
    return synth.allowed_personas(jsonl.personas(spark, path)).select(synth.system_turn(F.col("persona")).alias("system"))


def _structure(corpus: DataFrame) -> DataFrame:
    rows = quality.with_code_metrics(corpus.withColumn("clean_content", textfn.remove_comments("content")))
    names = lambda c: F.array_join(F.transform(c, lambda x: x["name"]), ",")
    return rows.select(
        "doc_id",
        names("function_definitions").alias("functions"),
        names("class_definitions").alias("classes"),
        F.array_join("imports", ",").alias("imports"),
        F.array_join(F.transform("function_definitions", lambda x: F.concat_ws("-", x["lineno"].cast("string"), x["end_lineno"].cast("string"), x["has_docstring"].cast("string"))), ",").alias("function_lines"),
        F.array_join(F.transform("class_definitions", lambda x: F.concat_ws("-", x["lineno"].cast("string"), x["end_lineno"].cast("string"), F.array_join(x["bases"], "+", "?"), x["has_docstring"].cast("string"))), ",").alias("class_lines"),
        "has_module_docstring",
        "cyclomatic_complexity",
        F.col("is_syntax_error"),
    )


def _page(spark: SparkSession, d: str, how, source: str) -> DataFrame:
    return html.extract(rendered.pages(table(spark, d, "repos")), how, source).select("title", "description", "source")


# Python's white space as an RE2 class body.
WS = r"\x{09}-\x{0D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
BREAK = r"\r\n|[\n\r\x{0B}\x{0C}\x{1C}-\x{1E}\x{85}\x{2028}\x{2029}]"


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^[{WS}]+|[{WS}]+$', '', 'g')"


def _clean(x: str) -> str:
    c = f"regexp_replace({x}, '#.*', '', 'g')"
    c = f"""regexp_replace({c}, '(?s)\"\"\".*?\"\"\"', '', 'g')"""
    return f"""coalesce(regexp_replace({c}, '(?s)''''''.*?''''''', '', 'g'), '')"""


def _lines(x: str) -> str:
    parts = f"regexp_split_to_array({x}, '{BREAK}')"
    return f"CASE WHEN {x} = '' THEN [] WHEN list_last({parts}) = '' THEN list_slice({parts}, 1, len({parts}) - 1) ELSE {parts} END"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _system_turns() -> list[str]:
    return [f"You are a {r}. {t} Complete the code. {m}" for r in ("teacher", "reviewer") for t in ("Be brief.", "Be kind.") for m, _ in synth.ADDITIONS]


def _persona_sql() -> str:
    nl = "chr(10)"
    ranked = sorted((mark, x, chr(10) * 2 + mark + chr(10) + text) for x in _system_turns() for mark, text in synth.ADDITIONS if x.endswith(mark))
    people = ", ".join(f"({i}, {_quoted(x)}, {_quoted(addition)})" for i, (_, x, addition) in enumerate(ranked, 1))
    wide = lambda slot, digits: f"('0x' || substr(md5('{SEED}|' || id || '|{slot}'), 1, {digits}))::BIGINT"
    part = lambda a, b: f"array_to_string(lines[{a}:{b}], {nl})"
    return f"""
        WITH s AS (SELECT lines, row_number() OVER (ORDER BY file_id) AS s FROM (SELECT file_id, string_split({_strip('content')}, {nl}) AS lines FROM source_docs WHERE file_path LIKE '%.py' AND content IS NOT NULL) WHERE len(lines) >= 3),
        p(p, system, addition) AS (VALUES {people}),
        d AS (SELECT id, {wide('s', 12)} % (SELECT count(*) FROM s) + 1 AS s, {wide('p', 12)} % (SELECT count(*) FROM p) + 1 AS p FROM range({PAIRS}) r(id)),
        a AS (SELECT *, 1 + {wide('a', 8)} % (len(lines) - 2) AS a FROM d JOIN s USING (s) JOIN p USING (p)),
        b AS (SELECT *, a + {wide('b', 8)} % (len(lines) - 1 - a) AS b FROM a)
        SELECT id, system, 'Please complete the missing part of the following Python code snippet:' || {nl} || {nl} || '{textfn.FIM_BEGIN}' || {part(1, 'a')} || '{textfn.FIM_HOLE}' || {part('b + 2', 'len(lines)')} || '{textfn.FIM_END}' AS ask,
               {part('a + 1', 'b + 1')} || addition AS answer FROM b"""


def _error_sql(draw) -> str:
    """The same templates and draws, put together by another engine."""
    rows = []
    for i, (kind, simple, hard) in enumerate(synth.TEMPLATES):
        for c, case in enumerate((simple, hard or simple)):
            rows.append(f"({i}, {c}, {', '.join(map(_quoted, (kind, *case)))})")
    pick = lambda words, slot: f"([{', '.join(map(_quoted, words))}][{draw(SEED, len(words), 'id::VARCHAR', _quoted(slot))} + 1])"
    title = lambda w: f"(upper({w}[1]) || {w}[2:])"
    number = lambda bound, least, slot: f"({draw(SEED, bound, 'id::VARCHAR', _quoted(slot))} + {least})::VARCHAR"
    whole = lambda bound, least, slot: f"({draw(SEED, bound, 'id::VARCHAR', _quoted(slot))} + {least})"
    first = f"{pick(synth.FIRST, 'va')} || '_' || {pick(synth.SECOND, 'vb')}"
    slots = {
        "{v}": first,
        "{w}": f"{pick(synth.FIRST, 'wa')} || '_' || {pick(synth.SECOND, 'wb')}",
        "{C}": f"{title(pick(synth.FIRST, 'Ca'))} || {title(pick(synth.SECOND, 'Cb'))}",
        "{n}": number(491, 10, "n"),
        "{m}": number(900, 100, "m"),
        "{p}": number(91, 10, "p"),
        "{q}": number(101, 100, "q"),
        "{L}": f"'[' || array_to_string(([{', '.join(number(100, 1, f'L{i}') for i in range(6))}])[1:{whole(4, 3, 'len')}], ', ') || ']'",
        "{i}": f"({whole(4, 3, 'len')} + {whole(3, 1, 'i')})::VARCHAR",
        "{a}": number(4, 3, "a"),
        "{b}": f"(({whole(4, 0, 'a')} + {whole(3, 1, 'b')}) % 4 + 3)::VARCHAR",
        "{t}": f"(({first})[:-2] || chr({whole(26, 97, 'x')}::INT))",
        "{z}": " || ".join(f"chr({whole(26, 97, f'z{i}')}::INT)" for i in range(10)),
        "{e}": " || ".join(number(10, 0, f"e{i}") for i in range(8)),
    }

    def filled(column: str) -> str:
        for slot in slots:
            column = f"replace({column}, '{slot}', \"{slot}\")"
        return column

    drawn = ", ".join(f'{e} AS "{s}"' for s, e in slots.items())
    return f"""
        WITH t(k, c, kind, title, log, description, buggy, fixed) AS (VALUES {', '.join(rows)}),
        d AS (SELECT id, {draw(SEED, len(synth.TEMPLATES), 'id::VARCHAR', _quoted('kind'))} AS k, {draw(SEED, 2, 'id::VARCHAR', _quoted('case'))} AS c, {drawn} FROM range({EXAMPLES}) r(id))
        SELECT id, kind, {filled('title')} AS title, {filled('log')} AS error_log, 'python' AS language, {filled('description')} AS description, {filled('buggy')} AS buggy_code_snippet, {filled('fixed')} AS fixed_code_snippet
        FROM d JOIN t USING (k, c)"""


def _maintainability() -> str:
    """The index of a rendered file by its formula, from the parts that the file was put together from."""
    volume = "(3.0 * len(funs) * log2(3.0))"
    logical = "(len(imports) + 4 * len(funs) + 4 * len(klass) + 3)"
    share = "(100.0 * CASE WHEN header = '' THEN 0 ELSE 1 END / (len(string_split(content, chr(10))) - 1))"
    return f"least(100.0, greatest(0.0, (171 - 5.2 * ln({volume}) - 0.23 * (2.0 * len(funs) + len(klass)) - 16.2 * ln({logical}) + 50 * sin(sqrt(2.46 * radians({share})))) * 100 / 171))"


def _lof_sql(rows: str, f4: str = "f4", shown: str = "round(lof, 6) AS lof") -> str:
    """The local outlier factor of ``rows`` (doc_id, f1..f4) by its definition."""
    return f"""
            WITH q AS ({rows}), r AS (SELECT doc_id, f1, f2, f3, {f4} AS f4 FROM q), v AS (SELECT f1, f2, f3, f4, count(*) AS c FROM r GROUP BY ALL),
            d AS (SELECT a.f1, a.f2, a.f3, a.f4, b.f1 AS g1, b.f2 AS g2, b.f3 AS g3, b.f4 AS g4, sqrt((a.f1 - b.f1) ** 2 + (a.f2 - b.f2) ** 2 + (a.f3 - b.f3) ** 2 + (a.f4 - b.f4) ** 2) AS dist,
                         b.c - CASE WHEN a.f1 = b.f1 AND a.f2 = b.f2 AND a.f3 = b.f3 AND a.f4 = b.f4 THEN 1 ELSE 0 END AS w FROM v a, v b),
            s AS (SELECT *, coalesce(sum(w) OVER (PARTITION BY f1, f2, f3, f4 ORDER BY dist, g1, g2, g3, g4 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM d),
            n AS (SELECT f1, f2, f3, f4, g1, g2, g3, g4, dist, least(w, 20 - before) AS w FROM s WHERE before < 20 AND w > 0),
            k AS (SELECT f1, f2, f3, f4, max(dist) AS kd FROM n GROUP BY ALL),
            l AS (SELECT n.f1, n.f2, n.f3, n.f4, 1 / (sum(greatest(k.kd, n.dist) * n.w) / sum(n.w) + 1e-10) AS lrd FROM n JOIN k ON n.g1 = k.f1 AND n.g2 = k.f2 AND n.g3 = k.f3 AND n.g4 = k.f4 GROUP BY ALL),
            o AS (SELECT n.f1, n.f2, n.f3, n.f4, sum(m.lrd * n.w) / sum(n.w) AS mean_lrd FROM n JOIN l m ON n.g1 = m.f1 AND n.g2 = m.f2 AND n.g3 = m.f3 AND n.g4 = m.f4 GROUP BY ALL),
            z AS (SELECT o.f1, o.f2, o.f3, o.f4, mean_lrd / l.lrd AS lof FROM o JOIN l USING (f1, f2, f3, f4)),
            x AS (SELECT r.doc_id, z.lof FROM r JOIN z USING (f1, f2, f3, f4))
            SELECT doc_id, {shown}, lof > (SELECT quantile_cont(lof, 0.9) FROM x) AS is_outlier FROM x"""


def oracle_sql() -> dict[str, str]:
    corpus = rendered.code_corpus_sql()
    nl = "chr(10)"
    ends = f"list_filter(list_transform(string_split(prefix_code, {nl}), lambda x, i: CASE WHEN i < len(string_split(prefix_code, {nl})) THEN x || {nl} ELSE x END), lambda x: x <> '')"
    page = "CASE WHEN coalesce(n_stars, 0) % 2 = 0 THEN 'Error' ELSE 'Notice' END"
    draw = lambda seed, bound, *parts: f"(('0x' || substr(md5(concat_ws('|', '{seed}', {', '.join(parts)})), 1, 8))::BIGINT % {bound})"
    kinds = ", ".join(f"'{t[0]}'" for t in synth.TEMPLATES)
    features = "SELECT doc_id, length(text)::DOUBLE AS f1, length(regexp_replace(text, '[^0-9]', '', 'g'))::DOUBLE AS f2, length(regexp_replace(text, '[^A-Z]', '', 'g'))::DOUBLE AS f3, length(regexp_replace(text, '[^\\n]', '', 'g'))::DOUBLE AS f4 FROM documents WHERE text IS NOT NULL"
    first_name = lambda c: f"regexp_extract({c}, '(?:def|class)[{WS}]+([A-Za-z0-9_]+)', 1)"
    asked = lambda c: f"'Please write ' || CASE WHEN {first_name(c)} = '' THEN 'a short script' ELSE {first_name(c)} END || ' in Python.'"
    fn_chunks = f"""
            WITH {corpus}, c AS (SELECT p, list_concat(funs,
                   list_concat(CASE WHEN len(klass) > 0 THEN ['class C' || p || '(Base):', 'def m(self):' || {nl} || '    return ' || p] ELSE [] END, ['x = 1' || {nl} || 'y = 2' || {nl} || 'z = 3'])) AS chunks FROM corpus WHERE NOT broken)
            SELECT p AS doc_id, unnest(range(0, len(chunks)))::INT AS idx, unnest(chunks) AS chunk FROM c"""
    turns = "SELECT record_id, unnest(range(0, len(messages)))::INT AS turn, unnest(messages) AS m FROM chat_records WHERE messages IS NOT NULL"

    return {
        "rule1_clean": "SELECT file_id, length(content)::INT AS original_content_length FROM source_docs WHERE content IS NOT NULL AND content <> ''",
        "dedup_content": "SELECT min(file_id) AS file_id FROM source_docs WHERE content IS NOT NULL AND content <> '' GROUP BY content",
        "text_metrics": f"""
            SELECT file_id,
                   round(CASE WHEN content IS NULL OR NOT regexp_matches(content, '[^{WS}]') THEN 1.0 ELSE length(regexp_replace(content, '[a-zA-Z0-9{WS}]', '', 'g'))::DOUBLE / length(content) END, 10) AS special_ratio,
                   length({_clean('content')})::INT AS content_length, len(lines)::INT AS number_of_lines,
                   round(CASE WHEN lines IS NULL OR len(lines) = 0 THEN CASE WHEN lines IS NULL THEN NULL ELSE 0.0 END ELSE len(list_filter(lines, lambda x: regexp_matches(x, '^[{WS}]*(#|\"\"\"|'''''')')))::DOUBLE / len(lines) END, 10) AS comment_ratio
            FROM (SELECT *, {_lines('content')} AS lines FROM source_docs)""",
        "remove_comments": f"SELECT file_id, md5({_clean('content')}) AS clean_md5 FROM source_docs",
        "min_len_filter": f"SELECT file_id, length({_clean('content')})::INT AS content_length FROM source_docs WHERE length({_clean('content')}) >= 10",
        "license_filter": "SELECT file_id FROM source_docs WHERE content IS NOT NULL AND NOT (length(content) > 500 AND (contains(content, 'Copyright') OR contains(content, 'License')))",
        "allowed_text": "SELECT file_id, coalesce(NOT regexp_matches(content, '[^\\x00-\\x7F\\x{FF5C}]'), false) AS allowed FROM source_docs",
        "unescape_project": "SELECT file_id, md5(replace(content, '\\/', '/')) AS content_md5 FROM source_docs WHERE content IS NOT NULL",
        "corpus_labels": f"""
            WITH {corpus}
            SELECT p AS doc_id, broken OR p % 11 = 0 AS is_syntax_error, (CASE WHEN broken THEN 0.0 ELSE 2.0 * len(funs) + len(klass) END)::DOUBLE AS cyclomatic_complexity,
                   len(string_split(content, {nl}))::INT - 1 AS number_of_lines, CASE WHEN broken OR {_maintainability()} < 20 THEN 0 ELSE 1 END AS label,
                   round(CASE WHEN broken THEN 0.0 ELSE {_maintainability()} END, 8) AS maintainability_index FROM corpus""",
        "stage_counts": f"""
            WITH {corpus}, x AS (SELECT p, CASE WHEN p % 9 = 0 THEN 'x = ' || p % 5 WHEN p % 13 = 0 THEN '' ELSE content END AS content, broken AND p % 9 <> 0 AS broken FROM corpus), f AS (SELECT * FROM x WHERE content <> ''),
            u AS (SELECT content, any_value(broken) AS broken FROM f GROUP BY content), k AS (SELECT * FROM u WHERE length({_clean('content')}) >= 10)
            SELECT 'loaded' AS stage, count(*) AS n_rows FROM x UNION ALL SELECT 'with_content', count(*) FROM f UNION ALL SELECT 'distinct', count(*) FROM u UNION ALL SELECT 'long_enough', count(*) FROM k
            UNION ALL SELECT 'good', count(*) FROM k WHERE NOT broken UNION ALL SELECT 'bad', count(*) FROM k WHERE broken""",
        "union_bad": f"""
            WITH {corpus}, c AS (SELECT p, broken, (2.0 * len(funs) + len(klass))::DOUBLE AS cc FROM corpus)
            SELECT p AS doc_id, 'rules' AS removed_by, NULL::DOUBLE AS cyclomatic_complexity FROM c WHERE broken UNION ALL SELECT p, 'outlier', cc FROM c WHERE NOT broken AND cc >= 7""",
        **{f"policy_{name}": _policy_sql(name) for name in jsonl.POLICIES},
        "jsonl_roundtrip": "SELECT triple_id AS line_no, prefix_code, target_code, suffix_code FROM fim_triples",
        "ascii_lines": f"WITH t AS ({turns}) SELECT true AS is_ascii, record_id, turn, m.role AS role, m.content AS content FROM t",
        "table_roundtrip": "SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_totalprice END AS price FROM orders",
        "batch_roundtrip": "SELECT file_id, (file_id % 3)::INT AS batch_no FROM source_docs WHERE file_id % 3 < 2",
        "log_roundtrip": f"SELECT DISTINCT {_strip('doc_id')} AS id FROM chat_records WHERE {_strip('doc_id')} <> ''",
        "persona_file": f"SELECT * FROM (VALUES {', '.join(f'({_quoted(x)})' for x in _system_turns())}) t(system)",
        "documents_scan": "SELECT file_id, doc_id, repo, file_path, n_bytes FROM source_docs WHERE n_bytes > 1000",
        "lof_features": _lof_sql(f"""
            WITH {corpus} SELECT p AS doc_id, length({_clean('content')})::DOUBLE AS f1, (2.0 * len(funs) + len(klass))::DOUBLE AS f2, round({_maintainability()}, 6) AS f3,
                   round(CASE WHEN header = '' THEN 0.0 ELSE 1.0 END + len(klass), 6) / (len(string_split(content, {nl})) - 1) AS f4 FROM corpus WHERE NOT broken AND {_maintainability()} >= 20""", "round(f4, 6)", "round(ln(lof), 6) AS log_lof"),
        "removed_rows": "SELECT file_id FROM source_docs WHERE file_id NOT IN (SELECT min(file_id) FROM source_docs GROUP BY content)",
        "code_structure": f"""
            WITH {corpus}
            SELECT p AS doc_id, CASE WHEN broken THEN '' ELSE array_to_string(list_concat(list_transform(range(0, len(funs)), lambda i: 'f' || i || '_' || p), list_transform(klass, lambda x: 'm')), ',') END AS functions,
                   CASE WHEN broken THEN '' ELSE array_to_string(list_transform(klass, lambda x: 'C' || p), ',') END AS classes,
                   CASE WHEN broken THEN '' ELSE array_to_string(list_slice(['os', 'sys', 'math.sqrt', 'json'], 1, len(imports)), ',') END AS imports,
                   CASE WHEN broken THEN '' ELSE array_to_string(list_concat(list_transform(range(0, len(funs)), lambda i: (top + 4 * i + 1) || '-' || (top + 4 * i + 4) || '-false'), list_transform(klass, lambda x: (top + 4 * len(funs) + 4) || '-' || (top + 4 * len(funs) + 5) || '-false')), ',') END AS function_lines,
                   CASE WHEN broken THEN '' ELSE array_to_string(list_transform(klass, lambda x: (top + 4 * len(funs) + 1) || '-' || (top + 4 * len(funs) + 5) || '-Base-true'), ',') END AS class_lines,
                   false AS has_module_docstring, (CASE WHEN broken THEN 0.0 ELSE 2.0 * len(funs) + len(klass) END)::DOUBLE AS cyclomatic_complexity, broken AS is_syntax_error
            FROM (SELECT *, len(imports) + CASE WHEN header = '' THEN 0 ELSE 1 END AS top FROM corpus)""",
        "valid_python": f"WITH {corpus} SELECT p AS doc_id, NOT broken AS is_valid FROM corpus",
        "short_fim": f"""
            WITH {corpus}, parts AS (SELECT *, unnest(range(0, len(stmts)))::INT AS idx FROM corpus WHERE NOT broken),
            t AS (SELECT p AS doc_id, idx, CASE WHEN idx = 0 THEN header ELSE stmts[idx] END AS prefix_code, stmts[idx + 1] AS target_code,
                         coalesce(array_to_string(list_slice(string_split(stmts[idx + 2], {nl}), 1, 3), {nl}), '') AS suffix_code FROM parts)
            SELECT * FROM t WHERE prefix_code <> '' AND suffix_code <> ''
            UNION ALL SELECT p, 0, '', content, '' FROM corpus WHERE broken""",
        "import_move": f"""
            WITH l AS (SELECT *, {ends} AS lines FROM fim_triples),
            i AS (SELECT *, list_filter(range(1, len(lines) + 1), lambda k: regexp_matches({_strip('lines[k]')}, '^(import|from) ')) AS places FROM l),
            m AS (SELECT *, CASE WHEN len(places) = 3 THEN places[3:3] WHEN len(places) > 3 THEN places[-2:] ELSE [] END AS moved FROM i)
            SELECT triple_id,
                   CASE WHEN len(coalesce(moved, [])) > 0 THEN coalesce(array_to_string(list_filter(lines, lambda x, k: NOT list_contains(moved, k)), ''), '') ELSE prefix_code END AS prefix_code,
                   CASE WHEN len(coalesce(moved, [])) > 0 THEN array_to_string(list_filter(lines, lambda x, k: list_contains(moved, k)), '') || coalesce(target_code, '') ELSE target_code END AS target_code,
                   suffix_code FROM m""",
        "fim_chat_render": f"""
            SELECT triple_id, 'Please complete the blank part of the following Python code:' || {nl} || {nl} || '```python' || {nl} || prefix_code || '# (Complete the code here)' || {nl} || suffix_code || '```' || {nl} || {nl} AS ask,
                   'Yes, I have completed the code as requested. Here is the completed code:' || {nl} || {nl} || '```python' || {nl} || '{textfn.FIM_BEGIN}' || prefix_code || '{textfn.FIM_HOLE}' || suffix_code || '{textfn.FIM_END}' || target_code || '{textfn.END_OF_TURN}' || {nl} || '```' AS answer
            FROM fim_triples WHERE prefix_code IS NOT NULL AND target_code IS NOT NULL AND suffix_code IS NOT NULL""",
        "merge_unique": "SELECT min(triple_id) AS triple_id, prefix_code, target_code, suffix_code FROM fim_triples GROUP BY prefix_code, target_code, suffix_code",
        "merge_all": "SELECT triple_id, prefix_code, target_code, suffix_code FROM fim_triples",
        "valid_lines": "SELECT triple_id AS line_no FROM fim_triples WHERE triple_id % 7 <> 0",
        "policy_records": "SELECT triple_id AS line_no, prefix_code, target_code, suffix_code FROM fim_triples WHERE triple_id % 7 <> 0",
        "anti_processed": "SELECT file_id, doc_id FROM source_docs s WHERE NOT EXISTS (SELECT 1 FROM chat_records c WHERE c.doc_id = s.doc_id)",
        "newest_unprocessed": "SELECT file_id FROM source_docs s WHERE NOT EXISTS (SELECT 1 FROM chat_records c WHERE c.doc_id = s.doc_id) ORDER BY file_id DESC LIMIT 100",
        "dialogue_pretty": f"""
            SELECT record_id, row_number() OVER (ORDER BY record_id) AS n,
                   '--- Dialogue ' || row_number() OVER (ORDER BY record_id) || ' ---' || {nl} || array_to_string(list_transform(coalesce(messages, []), lambda m: CASE m.role WHEN 'user' THEN 'User' WHEN 'assistant' THEN 'Assistant' ELSE upper(m.role[1]) || lower(m.role[2:]) END || ':' || {nl} || coalesce(m.content, '') || {nl} || {nl}), '') || '{chat.RULE}' || {nl} || {nl} AS value
            FROM chat_records""",
        "assistant_code_blocks": f"""
            WITH t AS ({turns}), b AS (SELECT record_id, turn, regexp_extract_all(m.content, '(?s)```(?:python)?\\n(.*?)```', 1) AS found, {_strip('m.content')} AS whole FROM t WHERE m.role = 'assistant' AND m.content IS NOT NULL),
            c AS (SELECT record_id, turn, CASE WHEN len(found) > 0 THEN found ELSE [whole] END AS blocks FROM b)
            SELECT record_id, turn, unnest(range(0, len(blocks)))::INT AS block, unnest(blocks) AS code FROM c""",
        "spacing_normalize": f"""
            WITH f AS (SELECT record_id, messages, list_filter(range(1, len(messages) + 1), lambda i: messages[i].role = 'assistant' AND messages[i].content IS NOT NULL)[1] AS first FROM chat_records WHERE messages IS NOT NULL),
            t AS (SELECT record_id, first, unnest(range(0, len(messages)))::INT AS turn, unnest(messages) AS m FROM f)
            SELECT record_id, turn, m.role AS role, CASE WHEN turn + 1 = first THEN regexp_replace({_strip('m.content')}, '\\n{{2,}}', {nl} || {nl}, 'g') ELSE m.content END AS content FROM t""",
        "chat_turns": f"WITH t AS ({turns}) SELECT record_id, turn, m.role AS role, m.content AS content FROM t",
        "chat_regroup": "SELECT record_id, len(messages)::INT AS n_turns, md5(array_to_string(list_transform(messages, lambda m: coalesce(m.content, '<null>')), '|')) AS joined_md5 FROM chat_records WHERE messages IS NOT NULL AND len(messages) > 0",
        "fn_chunks": fn_chunks,
        "fn_chunks_odd": rendered.odd_chunks_sql(),
        "cleaned_answers": rendered.answers_sql(),
        "instructions_function": f"SELECT doc_id, idx, {asked('chunk')} AS instruction, chunk AS code FROM ({fn_chunks})",
        "instructions_document": f"SELECT file_id, {asked('code')} AS instruction FROM (SELECT file_id, {_strip('content')} AS code FROM source_docs WHERE file_path LIKE '%.py') WHERE code <> '' AND length(code) <= 60000",
        "long_fim": f"""
            WITH {corpus}, r AS (
              SELECT *, string_split(content, {nl}) AS lines, len(imports) + CASE WHEN header = '' THEN 0 ELSE 1 END AS h, len(funs) AS nf FROM corpus),
            c AS (SELECT p, lines, h, nf, unnest(range(0, 1 + nf + 2 * len(klass))) AS i, 1 + nf + 2 * len(klass) AS n, len(klass) > 0 AS has_class FROM r),
            d AS (SELECT *, row_number() OVER (PARTITION BY p ORDER BY md5('{SEED}|' || p || '|' || i), i) AS draw FROM c),
            f AS (SELECT *, CASE WHEN i = 0 THEN 0 WHEN i <= nf THEN h + 4 * (i - 1) ELSE h + 4 * nf END AS start,
                         CASE WHEN i = 0 THEN h WHEN i < nf OR i = nf AND has_class THEN 4 WHEN i = nf THEN len(lines) - 1 - (h + 4 * (nf - 1)) ELSE 2 END AS k FROM d WHERE (n <= 5 OR draw <= 5) AND NOT (has_class AND i = n - 1)),
            x AS (SELECT *, row_number() OVER (PARTITION BY p ORDER BY i) - 1 AS idx FROM f)
            SELECT p AS doc_id, idx::INT AS idx, {_strip(f"array_to_string(lines[1:start], {nl})")} AS prefix_code, array_to_string(lines[start + 1:start + k], {nl}) AS target_code,
                   {_strip(f"array_to_string(lines[start + k + 1:], {nl})")} AS suffix_code FROM x WHERE start >= 3 AND len(lines) - start - k >= 3""",
        "page_headings": f"SELECT 'Error in' || repo AS title, 'Stars: ' || coalesce(n_stars, 0) AS description, 'headings' AS source FROM repos WHERE {page} = 'Error'",
        "page_headings_wide": f"SELECT {page} || ' in' || repo AS title, 'Stars: ' || coalesce(n_stars, 0) AS description, 'headings' AS source FROM repos UNION ALL SELECT 'Other', 'rest', 'headings' FROM repos",
        "page_definitions": "SELECT repo || 'Exception' AS title, 'has ' || coalesce(n_stars, 0) || ' stars' AS description, 'definitions' AS source FROM repos",
        "page_header_table": "SELECT 'E' || coalesce(n_stars, 0) AS title, repo AS description, 'tables' AS source FROM repos",
        "page_cell_table": "SELECT repo AS title, 'N/A' AS description, 'tables' AS source FROM repos UNION ALL SELECT coalesce(n_stars, 0)::VARCHAR, 'N/A', 'tables' FROM repos",
        "error_examples": _error_sql(draw),
        "persona_pairs": _persona_sql(),
        "persona_filter": f"SELECT * FROM (VALUES {', '.join(f'({_quoted(x)})' for x in _system_turns())}) t(system)",
        "error_kinds": f"SELECT [{kinds}][{draw(SEED, len(synth.TEMPLATES), 'id::VARCHAR', chr(39) + 'kind' + chr(39))} + 1] AS kind, count(*) AS n_examples FROM range({EXAMPLES}) t(id) GROUP BY 1",
        "lof_filter": _lof_sql(features),
    }
