"""DuckDB SQL over the same tables, one text per query."""

from __future__ import annotations

import re

# Fixed value: the whitespace Python strips, in the SQL engine's spelling.
_BLANK = (
    r"'[\t-\r\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]*'"
)

_ROWS = """
WITH turns AS (
  SELECT conv_id, turn, role, text,
         lead(role) OVER w AS next_role, lead(text) OVER w AS next_text
  FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)
), system_turns AS (
  SELECT conv_id, arg_min(text, turn) AS system_text
  FROM conversations WHERE role = 'system' GROUP BY conv_id
), pairs AS (
  SELECT t.conv_id, t.turn, t.text AS instruction,
         coalesce(s.system_text, '') AS input, t.next_text AS output
  FROM turns t LEFT JOIN system_turns s ON s.conv_id = t.conv_id
  WHERE t.role = 'user' AND t.next_role = 'assistant'
)
"""

_DOCUMENTS = "SELECT doc_id, text, lang, source, n_chars FROM documents"


def _lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _blank(column: str) -> str:
    return f"regexp_full_match({column}, {_BLANK})"


# Expected wording, with the columns' places in braces.
_ALPACA_WITH_INPUT = """\
Below is an instruction that describes a task, paired with an input that provides further context. \
Write a response that appropriately completes the request.

### Instruction:
{instruction}

### Input:
{input}

### Response:
{output}"""
_ALPACA_WITHOUT_INPUT = """\
Below is an instruction that describes a task. Write a response that appropriately completes the request.

### Instruction:
{instruction}

### Response:
{output}"""
_LOADER_WITH_INPUT = """\
Below is an instruction that describes a task, paired with an input that provides     further context. \
Write a response that appropriately completes the request.

### Instruction:
{instruction}

### Input:
{input}

### Response:
{output}"""
_LOADER_WITHOUT_INPUT = """\
Below is an instruction that describes a task. Write a response that appropriately     completes the request.

### Instruction:
{instruction}

### Response:
{output}"""
_CHATML = """\
<|im_start|>system
{system}<|im_end|>
<|im_start|>user
{user}<|im_end|>
<|im_start|>assistant
{assistant}<|im_end|>"""
_LLAMA = """\
<|begin_of_text|><|start_header_id|>system<|end_header_id|>

{system}<|eot_id|><|start_header_id|>user<|end_header_id|>

{user}<|eot_id|><|start_header_id|>assistant<|end_header_id|>

{assistant}<|eot_id|>"""
_CUSTOM_WITH_CONTEXT = """\
### System:
{system}

### Instruction:
{instruction}

### Context:
{input}

### Response:
{output}"""
_CUSTOM_WITHOUT_CONTEXT = """\
### System:
{system}

### Instruction:
{instruction}

### Response:
{output}"""
# End of the fixed values.


def _filled(template: str, **columns: str) -> str:
    """SQL that prints a template; names in braces are columns, or the expressions given for them."""
    parts = re.split(r"\{(\w+)\}", template)
    return " || ".join(
        columns.get(part, part) if n % 2 else _lit(part) for n, part in enumerate(parts) if n % 2 or part
    )


def _alpaca(with_input: str = _ALPACA_WITH_INPUT, without_input: str = _ALPACA_WITHOUT_INPUT) -> str:
    return f"CASE WHEN {_blank('input')} THEN {_filled(without_input)} ELSE {_filled(with_input)} END"


def _chatml(system: str, user: str, assistant: str) -> str:
    return _filled(_CHATML, system=system, user=user, assistant=assistant)


def _llama(system: str, user: str, assistant: str) -> str:
    return _filled(_LLAMA, system=system, user=user, assistant=assistant)


def _custom(system: str, context: bool) -> str:
    bare = _filled(_CUSTOM_WITHOUT_CONTEXT, system=_lit(system))
    if not context:
        return bare
    return f"CASE WHEN {_blank('input')} THEN {bare} ELSE {_filled(_CUSTOM_WITH_CONTEXT, system=_lit(system))} END"


def _text(expression: str) -> str:
    return f"{_ROWS} SELECT conv_id, turn, {expression} AS text FROM pairs"


_DEFAULT = "'You are a helpful assistant.'"
_EXPERT = "'You are a domain expert.'"

_SHAREGPT = """
SELECT conv_id, string_agg(
         '### ' || CASE role WHEN 'system' THEN 'System' WHEN 'user' THEN 'User' ELSE 'Assistant' END
         || ':' || chr(10) || text, chr(10) || chr(10) ORDER BY turn) AS text
FROM conversations GROUP BY conv_id
"""

_ORDER = """
SELECT doc_id, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) - 1 AS position FROM documents
"""



def _epochs(ordered: str, keys: str, seed: int, passes: int) -> str:
    """Common table ``dealt``: the keys, ``epoch``, ``position`` and ``epoch_position`` of each row in each epoch."""
    hashed = f"('0x' || substr(md5(concat_ws(':', {seed}, epoch, {{turn}}, {{digit}})), 1, 8))::BIGINT"
    moved = "SELECT *, x // low AS first, x % low AS second FROM walk, bases WHERE epoch > 0 AND (NOT moved OR x >= n)"
    for turn in range(4):
        digit, other, base = ("first", "second", "high") if turn % 2 == 0 else ("second", "first", "low")
        new = f"({digit} + {hashed.format(turn=turn, digit=other)}) % {base}"
        moved = f"SELECT * REPLACE ({new} AS {digit}) FROM ({moved})"
    return f"""
        WITH RECURSIVE ordered AS ({ordered}), roots AS (
            SELECT count(*) AS n, floor(sqrt(count(*) - 1))::BIGINT + 1 AS high FROM ordered
        ), bases AS (
            SELECT n, high, (n + high - 1) // high AS low FROM roots
        ), walk AS (
            SELECT {keys}, position, epoch, position AS x, false AS moved FROM ordered, range({passes}) epochs(epoch)
            UNION ALL
            SELECT {keys}, position, epoch, first * low + second, true FROM ({moved})
        ), dealt AS (
            SELECT {keys}, position, epoch::INT AS epoch, x AS epoch_position, n
            FROM walk, roots WHERE epoch = 0 OR (moved AND x < n)
        )"""


_ROLLUP = """
SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start,
       time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour' AS window_end,
       event_type AS tag, count(value) AS points, round(avg(value), 9) AS mean_value,
       min(value) AS min_value, max(value) AS max_value
FROM events GROUP BY ALL
"""


def _latest(tags: tuple[str, ...]) -> str:
    columns = ", ".join(
        f"""CASE WHEN count(*) FILTER (WHERE event_type = '{t}') = 0 THEN 'N/A'
             ELSE printf('%.4f', arg_max(value, event_id) FILTER (WHERE event_type = '{t}')) END AS "{t}" """
        for t in tags
    )
    return f"SELECT user_id AS run_id, {columns} FROM events GROUP BY user_id"


def _step_plan(setting: str, effective: int, epochs: int, max_steps: int | None = None) -> str:
    per_epoch = f"cast(ceil(count(*) / {effective}.0) AS BIGINT)"
    total = f"cast({max_steps} AS BIGINT)" if max_steps else f"{epochs} * {per_epoch}"
    return (
        f"SELECT '{setting}' AS setting, count(*) AS num_rows, cast({effective} AS BIGINT) AS effective_batch, "
        f"{per_epoch} AS steps_per_epoch, cast({total} AS BIGINT) AS total_steps FROM documents"
    )


ORACLES: dict[str, str] = {
    "scan_source": _DOCUMENTS,
    "scan_json": _DOCUMENTS,
    "scan_json_array": _DOCUMENTS,
    "scan_parquet": _DOCUMENTS,
    "scan_csv": _DOCUMENTS,
    "scan_dir_priority": _DOCUMENTS,
    "reload_prepared": _text(_alpaca()),
    "scan_prefix": "SELECT doc_id, text, source FROM documents WHERE starts_with(source, 'src1')",
    "land_local": _DOCUMENTS,
    "land_tree": """
        SELECT doc_id, text, CASE WHEN lang <> 'en' THEN lang END AS lang, source, n_chars FROM documents""",
    "land_then_add": """
        SELECT doc_id, cast(NULL AS BIGINT) AS item_id, text FROM documents
        UNION ALL SELECT NULL, item_id, text FROM benchmark""",
    "land_mixed_kinds": """
        SELECT doc_id, cast(NULL AS BIGINT) AS item_id, cast(NULL AS VARCHAR) AS conversation,
               cast(NULL AS VARCHAR) AS role, text
        FROM documents
        UNION ALL SELECT NULL, item_id, NULL, NULL, text FROM benchmark
        UNION ALL SELECT NULL, NULL, cast(conv_id AS VARCHAR), role, NULL FROM conversations""",
    "land_schema_change": """
        SELECT item_id, text, cast(NULL AS BIGINT) AS doc_id, cast(NULL AS INTEGER) AS quality,
               cast(NULL AS INTEGER) AS toxic
        FROM benchmark
        UNION ALL SELECT NULL, NULL, doc_id, quality, toxic FROM labels""",
    "split_slice": """
        WITH placed AS (
          SELECT *, row_number() OVER (PARTITION BY split ORDER BY doc_id) - 1 AS nth,
                 count(*) OVER (PARTITION BY split) AS total
          FROM (SELECT *, CASE doc_id % 10 WHEN 0 THEN 'test' ELSE 'train' END AS split FROM documents)
        )
        SELECT doc_id, split, 'head' AS slice, text FROM placed
        WHERE (split = 'train' AND nth < round_even(total / 10.0, 0)) OR (split = 'test' AND nth >= 5)
        UNION ALL
        SELECT doc_id, split, 'tail', text FROM placed WHERE split = 'train' AND nth >= total - 20""",
    "select_split": """
        SELECT doc_id, CASE doc_id % 10 WHEN 0 THEN 'test' ELSE 'train' END AS split, text FROM documents""",
    "read_version": """
        SELECT doc_id, CASE doc_id % 2 WHEN 0 THEN 'v1' ELSE 'v2' END AS version, text FROM documents""",
    "save_prepared": _SHAREGPT,
    "skip_if_exists": _DOCUMENTS,
    "verify_landing": """
        SELECT true AS has_files, cast(sum(strlen(text) + 1) AS BIGINT) AS num_bytes FROM documents""",
    "landing_counters": """
        SELECT true AS has_files,
               cast(sum(strlen(to_json({doc_id: doc_id, text: text, lang: lang, source: source, n_chars: n_chars})) + 1)
                    AS BIGINT) AS num_bytes,
               count(*) AS num_rows
        FROM documents""",
    "prep_manifest": f"""{_ROWS}
        SELECT 'conversations' AS source, 'chatml' AS format, count(*) AS num_samples,
               'conv_id,turn,instruction,input,output,text' AS columns,
               cast(sum(length({_chatml(_DEFAULT, "instruction", "output")})) AS BIGINT) AS num_chars
        FROM pairs""",
    "publish_versions": "SELECT doc_id, lang, source, text, upper(source) AS newest_source FROM documents",
    "run_record": """
        SELECT cast(user_id AS VARCHAR) AS run,
               strftime(max(ts), '%Y-%m-%dT%H:%M:%S') AS timestamp,
               'meta-llama/Llama-3.2-3B-Instruct' AS model_name, 'main' AS model_revision,
               'ended' AS version_tag, 'huggingface' AS dataset_source,
               'tatsu-lab/alpaca' AS dataset_name, '4bit' AS quantization,
               cast(16 AS BIGINT) AS lora_r, cast(32 AS BIGINT) AS lora_alpha,
               cast(512 AS BIGINT) AS max_seq_length, cast(1 AS DOUBLE) AS num_train_epochs,
               cast(0.0002 AS DOUBLE) AS learning_rate,
               cast(2 AS BIGINT) AS per_device_train_batch_size,
               cast(4 AS BIGINT) AS gradient_accumulation_steps,
               cast(1 AS BIGINT) AS world_size, cast(0 AS BIGINT) AS cuda_devices,
               cast(NULL AS VARCHAR) AS torch_version
        FROM events GROUP BY user_id""",
    "versioned_write": f"SELECT 'v1.0-docs' AS version, * FROM ({_DOCUMENTS})",
    "fmt_alpaca": _text(_alpaca()),
    "fmt_alpaca_loader": _text(_alpaca(_LOADER_WITH_INPUT, _LOADER_WITHOUT_INPUT)),
    "fmt_sharegpt": _SHAREGPT,
    "fmt_chatml": _text(_chatml(_EXPERT, "instruction", "output")),
    "fmt_llama": _text(_llama("input", "instruction", "output")),
    "fmt_custom": _text(_custom("You are a domain expert.", context=True)),
    "resolve_roles": f"""{_ROWS}
        SELECT conv_id, turn, {_DEFAULT} AS system, instruction AS user, output AS assistant FROM pairs""",
    "prepare_dispatch": f"""{_ROWS}, sharegpt AS ({_SHAREGPT})
        SELECT conv_id, turn, 'alpaca' AS format, {_alpaca()} AS text FROM pairs
        UNION ALL
        SELECT conv_id, turn, 'chatml', {_chatml(_DEFAULT, "instruction", "output")} FROM pairs
        UNION ALL
        SELECT conv_id, turn, 'llama', {_llama(_DEFAULT, "instruction", "output")} FROM pairs
        UNION ALL
        SELECT conv_id, turn, 'custom', {_custom("You are a helpful assistant.", context=False)} FROM pairs
        UNION ALL
        SELECT conv_id, cast(0 AS BIGINT), 'sharegpt', text FROM sharegpt""",
    "autodetect_format": _text(_alpaca(_LOADER_WITH_INPUT, _LOADER_WITHOUT_INPUT)),
    "resolve_text_field": f"""{_ROWS}
        SELECT 'documents' AS shape, 'text' AS text_field,
               cast(sum(length(text)) AS BIGINT) AS num_chars FROM documents
        UNION ALL
        SELECT 'documents_configured', 'text', cast(sum(length(text)) AS BIGINT) FROM documents
        UNION ALL
        SELECT 'questions_configured', 'answer', cast(sum(length(output)) AS BIGINT) FROM pairs
        UNION ALL
        SELECT 'questions_first_string', 'question', cast(sum(length(instruction)) AS BIGINT) FROM pairs""",
    "train_projection": "SELECT text FROM documents",
    "filter_empty": f"{_ROWS} SELECT conv_id, turn, input AS text FROM pairs WHERE NOT {_blank('input')}",
    "filter_report": f"""{_ROWS}
        SELECT count(*) AS rows_before, count(*) FILTER (WHERE NOT {_blank('input')}) AS rows_after FROM pairs""",
    "blank_predicate": f"{_ROWS} SELECT conv_id, turn, {_blank('input')} AS is_blank FROM pairs",
    "filter_roles": """
        SELECT conv_id, count(*) AS num_messages,
               count(*) FILTER (WHERE role <> 'system') AS num_kept,
               coalesce(string_agg(text, chr(10) ORDER BY turn) FILTER (WHERE role <> 'system'), '') AS kept
        FROM conversations GROUP BY conv_id""",
    "first_n": "SELECT doc_id, text FROM documents ORDER BY doc_id LIMIT 100",
    "first_n_filtered": "SELECT doc_id, text FROM documents WHERE lang = 'en' AND n_chars > 1000 ORDER BY doc_id LIMIT 60",
    "first_n_half": """
        SELECT doc_id, lang, n_chars FROM documents
        QUALIFY row_number() OVER (ORDER BY lang NULLS FIRST, n_chars NULLS FIRST, doc_id) <= (count(*) OVER () + 1) // 2""",
    "first_n_ties": "SELECT doc_id, lang, text FROM documents ORDER BY lang, doc_id LIMIT 70",
    "first_n_json": """
        SELECT doc_id, text FROM documents WHERE doc_id % 2 = 0
        UNION ALL (SELECT doc_id, text FROM documents WHERE doc_id % 2 = 1 ORDER BY doc_id LIMIT 7)""",
    "preview": "SELECT substr(text, 1, 500) AS preview FROM documents ORDER BY doc_id LIMIT 1",
    "count_rows": "SELECT count(*) AS num_rows FROM documents",
    "udf_format": _text("'Q: ' || instruction || chr(10) || 'A: ' || output"),
    "udf_map_nested": """
        SELECT doc_id, replace(text, chr(10), '|') AS joined, len(lines) AS num_lines,
               list_max(list_transform(lines, lambda line: length(line))) AS longest
        FROM (SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents)""",
    "udf_filter": f"{_ROWS} SELECT conv_id, turn, input FROM pairs WHERE NOT {_blank('input')}",
    "assemble_conversations": """
        SELECT conv_id, count(*) AS num_messages,
               string_agg(role || ': ' || text, chr(10) ORDER BY turn) AS messages
        FROM conversations GROUP BY conv_id""",
    "stream_assemble": """
        SELECT conv_id, count(*) AS num_messages,
               string_agg(role || ': ' || text, chr(10) ORDER BY turn) AS messages
        FROM conversations GROUP BY conv_id""",
    "stream_pairs": f"{_ROWS} SELECT conv_id, turn, instruction, input, output FROM pairs",
    "pair_turns": """
        WITH sparse AS (
          SELECT conv_id, turn * 700 + conv_id % 5 AS turn, role, text FROM conversations
        ), followed AS (
          SELECT *, lead(role) OVER w AS next_role, lead(text) OVER w AS output
          FROM sparse WINDOW w AS (PARTITION BY conv_id ORDER BY turn)
        )
        SELECT f.conv_id, f.turn, f.text AS instruction,
               coalesce((SELECT arg_min(s.text, s.turn) FROM sparse s
                         WHERE s.conv_id = f.conv_id AND s.role = 'system'), '') AS input,
               f.output
        FROM followed f WHERE f.role = 'user' AND f.next_role = 'assistant'""",
    "length_report": r"""
        WITH counted AS (
          SELECT source, lang, len(regexp_extract_all(coalesce(text, ''), '\S+'))::BIGINT AS n FROM documents
        )
        SELECT source, lang, count(*) AS num_rows, sum(n)::BIGINT AS num_tokens, max(n) AS max_tokens,
               round(sum(n)::DOUBLE / count(*), 6) AS mean_tokens, count(*) FILTER (n > 512) AS num_truncated,
               sum(greatest(n - 512, 0))::BIGINT AS tokens_cut, quantile_disc(n, 0.5) AS p50_tokens,
               quantile_disc(n, 0.9) AS p90_tokens, quantile_disc(n, 0.99) AS p99_tokens
        FROM counted GROUP BY source, lang""",
    "length_percentiles": """
        SELECT count(*) AS num_rows, quantile_disc(length(text), 0.01)::BIGINT AS p1_tokens,
               quantile_disc(length(text), 0.25)::BIGINT AS p25_tokens, quantile_disc(length(text), 0.5)::BIGINT AS p50_tokens,
               quantile_disc(length(text), 0.95)::BIGINT AS p95_tokens, max(length(text))::BIGINT AS p100_tokens
        FROM conversations""",
    "token_cap": r"""
        WITH tokenized AS (SELECT doc_id, regexp_extract_all(text, '\S+') AS tokens FROM documents)
        SELECT doc_id, cast(len(tokens) AS BIGINT) AS n_tokens, len(tokens) > 512 AS truncated,
               array_to_string(tokens[1:512], ' ') AS capped_tokens
        FROM tokenized""",
    "seeded_order": f"SELECT * FROM ({_DOCUMENTS}) JOIN ({_ORDER}) USING (doc_id)",
    "seeded_order_hot_keys": """
        SELECT lang, count(*) AS num_rows, count(DISTINCT position) AS num_places, min(position) AS first,
               max(position) AS last, sum(doc_id)::BIGINT AS ids
        FROM (SELECT lang, doc_id, row_number() OVER (ORDER BY md5('42:' || coalesce(lang, ''))) - 1 AS position FROM documents)
        GROUP BY lang""",
    "shard_ranks": f"SELECT doc_id, position, position % 4 AS rank FROM ({_ORDER})",
    "batch_assign": f"""
        SELECT *, position % 4 AS rank, position // 4 // 2 // 4 AS step,
               (position // 4 // 2) % 4 AS micro_step
        FROM ({_DOCUMENTS}) JOIN ({_ORDER}) USING (doc_id)""",
    "epoch_batches": f"""{_epochs(_ORDER, "doc_id", 42, 3)}, stepped AS (
            SELECT doc_id, position, epoch, epoch_position, epoch_position % 4 AS rank,
                   epoch_position // 4 // 2 // 4 + epoch * ((n + 31) // 32) AS step,
                   (epoch_position // 4 // 2) % 4 AS micro_step, ceil(((n + 31) // 32) * 2.5) AS total
            FROM (SELECT * REPLACE (epoch::BIGINT AS epoch) FROM dealt)
        )
        SELECT doc_id, position, epoch::INT AS epoch, epoch_position, rank, step, micro_step FROM stepped WHERE step < total""",
    "epoch_batches_max_steps": f"""{_epochs(
        "SELECT conv_id, turn, row_number() OVER (ORDER BY md5('7:' || conv_id || chr(31) || turn), conv_id, turn) - 1 AS position"
        " FROM conversations", "conv_id, turn", 7, 60)}, stepped AS (
            SELECT *, epoch_position % 2 AS rank, epoch_position // 2 // 4 + epoch * ((n + 7) // 8) AS step FROM dealt
        )
        SELECT rank, step, count(*) AS num_rows, min(epoch_position) AS first, sum(conv_id * (turn + 1))::BIGINT AS mark
        FROM stepped WHERE step < 100 GROUP BY rank, step""",
    "resume_from_step": f"""
        SELECT doc_id, text, position, position % 3 AS rank, position // 3 // 2 AS step
        FROM documents JOIN ({_ORDER}) USING (doc_id) WHERE position // 6 BETWEEN 5 AND 19""",
    "step_plan": " UNION ALL ".join(
        (
            _step_plan("demo", 4 * 2 * 4, 1),
            _step_plan("production", 8 * 8 * 2, 3),
            _step_plan("production_override", 8 * 4 * 8, 3),
            _step_plan("dry_run", 4 * 2 * 4, 1, max_steps=5),
        )
    ),
    "retain_last_k": """
        SELECT source, doc_id,
               row_number() OVER (PARTITION BY source ORDER BY doc_id DESC) > 3 AS expired
        FROM documents""",
    "stream_ingest": f"""
        SELECT doc_id, {_filled(_CUSTOM_WITHOUT_CONTEXT, system=_DEFAULT, instruction="source", output="text")} AS text
        FROM documents""",
    "stream_then_train": f"""
        SELECT doc_id, position, {_filled(_CUSTOM_WITHOUT_CONTEXT, system=_DEFAULT, instruction="source", output="text")} AS text
        FROM documents JOIN ({_ORDER}) USING (doc_id)""",
    "stream_prepare": _SHAREGPT,
    "metric_rollup": _ROLLUP,
    "incremental_rollup": _ROLLUP,
    "stream_metric_rollup": f"""
        SELECT * FROM ({_ROLLUP})
        WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL '10 minutes'""",
    "latest_metric": _latest(("click", "error", "purchase", "signup", "view", "train_loss")),
}
