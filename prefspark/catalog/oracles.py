"""SQL over the same tables for every registered query, in DuckDB's dialect."""

from __future__ import annotations

from prefspark.backends.standin import TOKEN
from prefspark.catalog.queries import (
    CACHED_GAMMA,
    DIGITS,
    FRACTION,
    GAMMA,
    QUERY_STOPS,
    SAMPLE_SIZE,
    SCORED_UNITS,
    SHARES,
    SYSTEM,
)
from prefspark.constants import (
    CRITERIA,
    MAX_CONTEXT,
    MAX_NEW,
    MAX_RETRIES,
    MAX_ROUNDS,
    PARSE_FAILURE,
    RUBRIC_HEADER,
    SAMPLE_FRACTION,
    SEED,
    STOPS,
)
from prefspark.functions import prompts

# Building blocks


def _text(value: str) -> str:
    """A string literal."""
    return "'" + value.replace("'", "''") + "'"


def _with(select: str, **ctes: str) -> str:
    blocks = ",\n".join(f"{name} as ({body})" for name, body in ctes.items())
    return f"with {blocks}\n{select}"


def _digit(text: str, place: int) -> str:
    return f"(instr('0123456789abcdef', substr(md5({text}), {place}, 1)) - 1)"


def _with_digest(text: str, salt: str = "") -> str:
    return f"({text} || ' ' || md5('{salt}' || {text}))"


def _rubric_lines(text: str) -> str:
    return " || ".join(
        f"chr(10) || '* {name}: ' || ({_digit(text, j)} % 5 + 1) || '/5 - note on {name}'"
        for j, name in enumerate(CRITERIA, start=1)
    )


def _critique(text: str) -> str:
    return f"('{RUBRIC_HEADER}' || {_rubric_lines(text)})"


def _units(text: str) -> str:
    return rf"regexp_extract_all({text}, '\S+')"


def _over(text: str, budget: int) -> str:
    return f"(len({_units(text)}) > {budget})"


def _head(text: str, budget: int) -> str:
    kept = rf"array_to_string(regexp_extract_all({text}, '\s*\S+')[1:{budget}], '')"
    return f"(case when {_over(text, budget)} then {kept} else {text} end)"


def _tail(text: str, budget: int) -> str:
    kept = rf"array_to_string(regexp_extract_all({text}, '\S+\s*')[-{budget}:], '')"
    return f"(case when {_over(text, budget)} then {kept} else {text} end)"


def _trim(text: str, stops: tuple[str, ...]) -> str:
    found = ", ".join(f"nullif(instr({text}, {_text(stop)}), 0)" for stop in stops)
    return f"coalesce(left({text}, list_min([{found}]) - 1), {text})"


def _generated_texts(text: str) -> str:
    """Responses to `text`, which is a column already cut to the budget."""
    texts = [_with_digest(text, f"{k}:{SEED}:") for k in (1, 2)]
    return f"list_transform([{', '.join(texts)}], lambda r: {_trim('r', STOPS)})"


def _score(text: str, response: str) -> str:
    return f"(('0x' || substr(md5({text} || chr(10) || {response}), 1, 8))::bigint / 4294967296.0::double)"


def _scores(text: str = "instruction", responses: str = "responses") -> str:
    return f"list_transform({responses}, lambda r: {_score(text, 'r')})"


def _budgeted(text: str, responses: str, budget: int) -> tuple[str, str]:
    """Scores of the conversations' tails, and which of them were cut."""
    asked_units, answer_units = f"len({_units(text)})", f"len({_units('r')})"
    pieces = rf"regexp_extract_all({text}, '\S+\s*')"
    asked = f"""(case when {asked_units} + {answer_units} <= {budget} then {text}
        when {answer_units} >= {budget} then case when {asked_units} = 0 then {text} else '' end
        else array_to_string({pieces}[-({budget} - {answer_units}):], '') end)"""
    scores = f"list_transform({responses}, lambda r: {_score(asked, _tail('r', budget))})"
    flags = f"list_transform({responses}, lambda r: {asked_units} + {answer_units} > {budget})"
    return scores, flags


def _tokens(text: str) -> str:
    return f"regexp_extract_all({text}, '{TOKEN}')"


def _token_head(text: str, most: int) -> str:
    return f"array_to_string({_tokens(text)}[1:{most}], '')"


def _token_tail(text: str, most: str) -> str:
    """The last tokens, none where `most`, an expression, is not positive."""
    return f"(case when {most} > 0 then array_to_string({_tokens(text)}[-({most}):], '') else '' end)"


_SHOWN = MAX_CONTEXT - MAX_NEW


_COLLAPSE = {
    "min": "list_min(scores)",
    "max": "list_max(scores)",
    "mean": "list_sum(scores) / len(scores)",
}


def _collapsed(how: str) -> str:
    return f"(case when len(scores) > 0 then {_COLLAPSE[how]} end)"


def _each(responses: str = "responses", prefix: str = "response") -> str:
    return f"{responses}[1] as {prefix}_1, {responses}[2] as {prefix}_2"


DOCUMENTS = """
    select cast(doc_id as varchar) as record_id, text as instruction, lang, source, n_chars
    from documents"""

INSTRUCTIONS = """
    select cast(doc_id as varchar) as record_id, text as instruction from documents"""

LABELS = "select cast(doc_id as varchar) as record_id, quality, toxic from labels"

ALL_PAIRS = """
    select cast(conv_id as varchar) as record_id,
        arg_min(text, turn) filter (where role = 'user') as instruction,
        coalesce(list(text order by turn) filter (where role = 'assistant'), []) as responses
    from conversations group by conv_id"""

PAIRS = f"select record_id, instruction, responses[1:2] as responses from ({ALL_PAIRS})"

SCORED_PAIRS = f"select *, {_scores()} as scores from ({PAIRS})"

TURNS = f"""
    select p.record_id, c.turn, p.instruction, c.text as response
    from ({ALL_PAIRS}) p
    join conversations c on cast(c.conv_id as varchar) = p.record_id and c.role = 'assistant'"""

SCORED_TURNS = f"""
    select record_id, turn, {_score('instruction', 'response')} as score
    from ({TURNS})"""

GAPS = f"""
    select record_id, instruction from ({DOCUMENTS})
    union all
    select 'gap ' || record_id, case lang when 'fr' then null when 'es' then '' else '  ' end
    from ({DOCUMENTS}) where lang in ('fr', 'es', 'de') or source = 'src0'"""

DONE = f"""
    select instruction from ({INSTRUCTIONS})
    where record_id in (select record_id from ({LABELS}) where quality = 1)"""

CACHE = f"""
    select record_id, instruction,
        [{_with_digest('instruction', 'a:')}, {_with_digest('instruction', 'b:')}] as responses,
        {_critique('instruction')} as feedback,
        instruction as original_instruction,
        [{_with_digest('instruction', 'a:')}, {_with_digest('instruction', 'b:')}] as original_responses,
        '[' || record_id || '] ' || instruction as refined_instruction,
        [{_with_digest('instruction', 'c:')}, {_with_digest('instruction', 'd:')}] as refined_responses,
        0 as round
    from ({INSTRUCTIONS}) where record_id in (select record_id from ({LABELS}))"""

# The first log row per instruction, by round and record id.
FIRST_LOGGED = f"""
    select * from ({CACHE})
    qualify row_number() over (partition by instruction order by round, record_id) = 1"""

GENERATED = f"""
    select record_id, instruction, over_budget, {_generated_texts('shown')} as responses
    from (select *, {_head('instruction', _SHOWN)} as shown,
            {_over('instruction', _SHOWN)} as over_budget
        from ({INSTRUCTIONS}))"""

# Rubric

# Fixed patterns: a line counts for validation under the strict one, and the loose one reads it.
STRICT_LINE = r"^\*\s*(" + "|".join(CRITERIA) + r")\s*:\s*[1-5]/5\s*-\s*.+$"
LOOSE_LINE = r"^\*\s*([\p{L}\p{N}_]+):\s*(\d)/5\s*-\s*(.+)"

_BLOCK = "block"
_VARIANTS = [
    _BLOCK,
    "replace(block, 'Evaluation:', 'evaluation:')",
    "'Here it is.' || chr(10) || block || chr(10) || 'That is all.'",
    "replace(block, 'Safety:', 'Safety :')",
    "block || chr(10) || '* Clarity: 9/5 - more'",
    "block || chr(10) || '* Tone: 3/5 - more'",
    "block || chr(10) || '* Clarity: 1/5 - more'",
    "replace(block, '* Safety', '- Safety')",
    "regexp_replace(block, 'Clarity: [1-5]/5', 'Clarity: 6/5')",
    "''",
    "replace(block, chr(10), chr(13) || chr(10))",
    "replace(block, 'note on Safety', '')",
    "'Evaluation:' || chr(10) || array_to_string("
    "list_reverse(string_split(block, chr(10))[2:8]), chr(10))",
    "replace(block, '* ', '*  ')",
    "replace(block, chr(10), chr(10) || '   ')",
    "block || chr(10) || 'Evaluation:'",
    "block || chr(10) || '* Qualité: 3/5 - more'",
    "replace(block, chr(10), chr(13))",
]
RUBRIC_TEXTS = f"""
    select record_id,
        [{', '.join(_VARIANTS)}][('0x' || substr(md5(instruction), 31, 2))::int % {len(_VARIANTS)} + 1] as feedback
    from (select record_id, instruction, {_critique('instruction')} as block
        from ({INSTRUCTIONS}))"""

_BLANKS = "' ' || chr(9) || chr(10) || chr(12) || chr(13)"
_NAME_LIST = "[" + ", ".join(f"'{name}'" for name in CRITERIA) + "]"


def _read_rubric(source: str) -> str:
    """Adds is_valid, readable and entries (criterion, score, note) to rows with feedback."""
    return f"""
    select * exclude (lines, seen, body, seen_body, strict, loose),
        coalesce(list_sort(strict) = list_sort({_NAME_LIST}), false) as is_valid,
        coalesce(list_sort(strict) = list_sort({_NAME_LIST})
            and list_sort(list_distinct(list_transform(loose, lambda l: l.criterion)))
                = list_sort({_NAME_LIST}), false) as readable,
        list_transform({_NAME_LIST}, lambda n:
            list_filter(loose, lambda l: l.criterion = n)[-1]) as entries
    from (select *,
            list_transform(list_filter(body, lambda l: regexp_matches(l, {_text(STRICT_LINE)})),
                lambda l: regexp_extract(l, {_text(STRICT_LINE)}, 1)) as strict,
            list_transform(list_filter(seen_body, lambda l: regexp_matches(l, {_text(LOOSE_LINE)})),
                lambda l: {{
                    'criterion': regexp_extract(l, {_text(LOOSE_LINE)}, 1),
                    'score': cast(regexp_extract(l, {_text(LOOSE_LINE)}, 2) as int),
                    'note': trim(regexp_extract(l, {_text(LOOSE_LINE)}, 3), {_BLANKS})
                }}) as loose
        from (select *, case when list_position(lines, '{RUBRIC_HEADER}') > 0
                then lines[list_position(lines, '{RUBRIC_HEADER}') + 1:] else [] end as body,
                case when list_position(seen, '{RUBRIC_HEADER}') > 0
                then seen[list_position(seen, '{RUBRIC_HEADER}') + 1:] else [] end as seen_body
            from (select *, list_transform(string_split_regex(feedback, '\\r\\n|\\n|\\r'),
                    lambda l: trim(l, {_BLANKS})) as lines,
                    list_transform(string_split(feedback, chr(10)), lambda l: trim(l, {_BLANKS})) as seen
                from ({source}))))"""


READ_RUBRICS = _read_rubric(RUBRIC_TEXTS)
_MEAN = f"list_sum(list_transform(entries, lambda e: e.score)) / {len(CRITERIA)}.0::double"

ATTEMPTS = "\n    union all ".join(
    f"""select record_id, instruction, {k} as attempt,
        case when {k} = 1 and {_digit('instruction', 10)} = 0 then null
            when {_digit('instruction', 9)} % 4 >= {k} then {_rubric_lines('instruction')}
            else {_critique('instruction')} end as feedback,
        case when {k} = 1 and {_digit('instruction', 10)} = 0
            then 'TimeoutError: no reply' end as error
    from ({INSTRUCTIONS})"""
    for k in range(1, MAX_RETRIES + 1)
)

FIRST_CRITIQUES = f"""
    select record_id, feedback, case when error is null then {_with_digest('instruction')} end
        as refined_instruction, error
    from ({ATTEMPTS}) where attempt = 1"""

OUTCOMES = f"""
    select record_id, feedback, error, entries
    from ({_read_rubric(ATTEMPTS)})
    where error is not null or readable
    qualify row_number() over (partition by record_id order by attempt) = 1"""

_FLAT = ", ".join(
    f"case when o.error is null then entries[{j}].score end as {name.lower()}"
    for j, name in enumerate(CRITERIA, start=1)
)

REPORT = f"""
    select i.record_id, o.feedback, {_FLAT}, i.instruction, {_MEAN} as feedback_avg_score
    from ({INSTRUCTIONS}) i join ({OUTCOMES}) o on o.record_id = i.record_id
    where o.error is null"""

# Sampling


def _sample(source: str, size: str) -> str:
    return f"""
    select * exclude (place, n)
    from (select *, row_number() over (order by md5('{SEED}:' || record_id), record_id) as place,
            count(*) over () as n
        from ({source}))
    where place <= {size}"""


def _fraction(source: str, fraction: float) -> str:
    return _sample(source, f"floor(n * {fraction}::double)")


REPEATED_IDS = f"""
    select case when lang <> 'en' then cast(cast(record_id as bigint) % 10 as varchar) end as record_id, instruction
    from ({DOCUMENTS})
    union all select null, 'equal' from ({DOCUMENTS}) where source = 'src0'"""


def _sized(column: str) -> str:
    return f"coalesce(strlen({column}) || ':' || {column}, '-')"


# Rows in seeded order, those with one id by their content.
SHUFFLED = f"""
    select *, row_number() over (order by md5('{SEED}:' || coalesce(record_id, '')),
            md5({_sized('record_id')} || {_sized('instruction')})) - 1 as place,
        count(*) over () as n
    from ({REPEATED_IDS})"""

# Rounds


def _rounds(source: str, gamma: float, agg: str, cached: bool, budget: int | None = None) -> dict[str, str]:
    """CTEs in<i>, routed<i> and log<i> for every round, and `ended` with where records ended."""
    asked = ("r.instruction", "r.responses")
    scores, flags = (_scores(*asked), "cast(null as boolean[])") if budget is None else _budgeted(*asked, budget)
    hits = FIRST_LOGGED if cached else f"select * from ({CACHE}) where false"
    ctes = {
        "hits": hits,
        "in0": f"""select record_id, instruction, responses[1:2] as responses,
            cast(null as varchar) as original_instruction,
            cast(null as varchar[]) as original_responses from ({source})""",
    }
    for i in range(MAX_ROUNDS):
        ctes[f"routed{i}"] = f"""
            select *, case when is_hit then 'cached'
                when {_collapsed(agg)} is null then 'invalid'
                when {_collapsed(agg)} < {gamma}::double then 'refine' else 'accepted' end as route
            from (select r.*, h.record_id is not null as is_hit,
                    case when h.record_id is null then {scores} end as scores, {flags} as flags
                from in{i} r left join hits h on h.instruction = r.instruction)"""
        ctes[f"log{i}"] = f"""
            select record_id, {i} as round, false as from_cache, instruction, responses,
                {_critique('instruction')} as feedback,
                coalesce(original_instruction, instruction) as original_instruction,
                coalesce(original_responses, responses) as original_responses,
                refined_instruction, {_generated_texts('shown')} as refined_responses,
                over_budget, cast(null as varchar) as error
            from (select *, {_head('refined_instruction', _SHOWN)} as shown,
                    {_over('refined_instruction', _SHOWN)} as over_budget
                from (select *, {_with_digest('instruction')} as refined_instruction
                    from routed{i} where route = 'refine'))
            union all
            select r.record_id, {i}, true, r.instruction, h.responses, h.feedback,
                h.original_instruction, h.original_responses, h.refined_instruction,
                h.refined_responses, null, null
            from routed{i} r join hits h on h.instruction = r.instruction
            where r.route = 'cached'"""
        ctes[f"in{i + 1}"] = f"""
            select record_id, refined_instruction as instruction, refined_responses as responses,
                original_instruction, original_responses from log{i}"""
    ends = [
        f"""select record_id, '{status}' as status, {i} as round, instruction, responses,
            coalesce(original_instruction, instruction) as original_instruction,
            coalesce(original_responses, responses) as original_responses, scores
        from routed{i} where route = '{status}'"""
        for i in range(MAX_ROUNDS)
        for status in ("accepted", "invalid")
    ]
    ends.append(
        f"""select record_id, 'left', null, instruction, responses, original_instruction,
            original_responses, null from in{MAX_ROUNDS}"""
    )
    ctes["ended"] = " union all ".join(ends)
    return ctes


_BUDGET_SCORES, _BUDGET_FLAGS = _budgeted("instruction", "responses", SCORED_UNITS)
BUDGET_REPORT = f"""
    select record_id, {_each('scores', 'score')}, {_each('flags', 'cut')},
        (scores[1] + scores[2]) / 2 as avg_score
    from (select record_id, {_BUDGET_SCORES} as scores, {_BUDGET_FLAGS} as flags from ({GENERATED}))"""

_ROOM = f"({SCORED_UNITS} - len({_tokens('r')}))"
TOKEN_REPORT = f"""
    select record_id, {_each('scores', 'score')}, {_each('flags', 'cut')},
        (scores[1] + scores[2]) / 2 as avg_score
    from (select record_id,
            list_transform(responses, lambda r:
                {_score(_token_tail('instruction', _ROOM), _token_tail('r', str(SCORED_UNITS)))}) as scores,
            list_transform(responses, lambda r:
                len({_tokens('instruction')}) + len({_tokens('r')}) > {SCORED_UNITS}) as flags
        from ({GENERATED}))"""

PAIR_ROUNDS = _rounds(PAIRS, GAMMA, "min", cached=False)
DOCUMENT_ROUNDS = _rounds(GENERATED, CACHED_GAMMA, "mean", cached=True)

_OUTCOME = f"""
    select record_id, status, round, instruction, {_each()}, original_instruction,
        {_each('original_responses', 'original_response')}, {_each('scores', 'score')}
    from ended"""


def _both_sides(where: str, columns: str) -> str:
    return f"""
    select record_id, 'refined' as side, {columns} instruction, {_each()}
    from ended where {where}
    union all
    select record_id, 'original', {columns} original_instruction, {_each('original_responses')}
    from ended where {where}"""


ORACLES: dict[str, str] = {
    "scan_instructions": DOCUMENTS,
    "project_instruction": INSTRUCTIONS,
    "drop_empty_instruction": f"""
        select * from ({GAPS}) where instruction is not null and instruction <> ''""",
    "type_guard": f"""
        select record_id, json_extract_string(value, '$.instruction') as instruction
        from (select record_id, json_object('instruction', instruction) as value from ({DOCUMENTS})
            union all
            select 'gap ' || record_id, case when lang = 'fr' then json_object('instruction', n_chars)
                when lang = 'es' then json_object('record_id', record_id)
                else json_object('instruction', [n_chars]) end
            from ({DOCUMENTS}) where source <> 'src0' and lang in ('fr', 'es', 'de'))
        where json_type(value, '$.instruction') = 'VARCHAR'""",
    "jsonl_round_trip": INSTRUCTIONS,
    "jsonl_absent_keys": f"select *, true as no_responses from ({INSTRUCTIONS})",
    "jsonl_ordered_export": f"""
        select record_id, row_number() over (order by record_id) - 1 as place from ({INSTRUCTIONS})""",
    "jsonl_tolerant_read": f"""
        select record_id, instruction from ({DOCUMENTS})
        union all
        select 'gap ' || record_id, case lang when 'fr' then cast(n_chars as varchar)
            when 'de' then '[' || cast(n_chars as varchar) || ']' end
        from ({DOCUMENTS}) where source <> 'src0' and lang in ('fr', 'es', 'de')""",
    "truncate_responses": f"""
        select record_id, cast(len(responses) as int) as n_responses, {_each()} from ({PAIRS})""",
    "render_chat": f"""
        select record_id, 0 as place, 'system' as role, {_text(SYSTEM)} as content
        from ({INSTRUCTIONS})
        union all select record_id, 1, 'user', instruction from ({INSTRUCTIONS})""",
    "render_scored_chat": f"""
        select record_id, turn, 0 as place, 'user' as role, instruction as content from ({TURNS})
        union all select record_id, turn, 1, 'assistant', response from ({TURNS})""",
    "render_critique_prompt": f"""
        select record_id, {_text(prompts.CRITIQUE_HEAD)} || instruction
            || {_text(prompts.CRITIQUE_TAIL)} as prompt
        from ({INSTRUCTIONS})""",
    "render_rewrite_prompt": f"""
        select record_id, {_text(prompts.REWRITE_HEAD)} || instruction
            || {_text(prompts.REWRITE_MIDDLE)} || {_critique('instruction')}
            || {_text(prompts.REWRITE_TAIL)} as prompt
        from ({INSTRUCTIONS})""",
    "prompt_budget_head": f"""
        select record_id, {_over('instruction', MAX_CONTEXT - MAX_NEW)} as over_budget,
            {_head('instruction', MAX_CONTEXT - MAX_NEW)} as kept
        from ({INSTRUCTIONS})""",
    "prompt_budget_tail": f"""
        select record_id, {_over('instruction', MAX_CONTEXT)} as over_budget,
            {_tail('instruction', MAX_CONTEXT)} as kept
        from ({INSTRUCTIONS})""",
    "prompt_budget_tokens": f"""
        select record_id, len({_tokens('instruction')}) > {_SHOWN} as over_prompt,
            {_token_head('instruction', _SHOWN)} as head,
            len({_tokens('instruction')}) > {MAX_CONTEXT} as over_context,
            {_token_tail('instruction', str(MAX_CONTEXT))} as tail
        from ({INSTRUCTIONS})""",
    "trim_at_stops": f"""
        select conv_id, turn, {_trim('text', QUERY_STOPS)} as trimmed
        from conversations where role = 'assistant'""",
    "lineage_coalesce": f"""
        select i.record_id,
            case when quality = 0 then {_with_digest('instruction')} else instruction end as instruction,
            instruction as original_instruction,
            case when quality = 0 then {_with_digest('instruction', 'b:')}
                else {_with_digest('instruction', 'a:')} end as original_response
        from ({INSTRUCTIONS}) i left join ({LABELS}) l on l.record_id = i.record_id""",
    "resume_anti_join": f"""
        select * from ({INSTRUCTIONS}) i
        where not exists (select 1 from ({DONE}) d where d.instruction = i.instruction)
            and instruction <> ''""",
    "resume_retries_failed": f"""
        select * from ({INSTRUCTIONS})
        where instruction <> '' and instruction not in (
            select instruction from ({INSTRUCTIONS}) i join ({LABELS}) l on l.record_id = i.record_id
            where toxic = 0)""",
    "cache_lookup": f"""
        select i.record_id, h.record_id is not null as is_hit, h.feedback, h.original_instruction,
            h.refined_instruction, {_each('h.refined_responses')}
        from ({INSTRUCTIONS}) i left join ({FIRST_LOGGED}) h on h.instruction = i.instruction""",
    "cache_hits": f"""
        select * from ({INSTRUCTIONS})
        where instruction in (select instruction from ({CACHE}))""",
    "cache_from_file": f"""
        select * from ({INSTRUCTIONS})
        where instruction in (select instruction from ({CACHE}))""",
    "cache_first_by_position": f"""
        select i.record_id, h.record_id is not null as is_hit, h.refined_instruction, {_each('h.refined_responses')}
        from ({INSTRUCTIONS}) i left join (
            select * from ({CACHE})
            qualify row_number() over (partition by instruction order by cast(record_id as bigint) desc) = 1
        ) h on h.instruction = i.instruction""",
    "align_outputs": f"""
        select i.record_id, i.instruction, l.quality, l.toxic
        from ({INSTRUCTIONS}) i left join ({LABELS}) l on l.record_id = i.record_id""",
    **{
        f"score_agg_{how}": f"select record_id, {_collapsed(how)} as score from ({SCORED_PAIRS})"
        for how in _COLLAPSE
    },
    "score_responses": SCORED_TURNS,
    "score_responses_worker": SCORED_TURNS,
    "reward_avg_per_record": f"""
        select p.record_id, count(score) as n_responses,
            round(coalesce(sum(score) / nullif(count(score), 0), 0), {DIGITS}) as avg_score
        from ({ALL_PAIRS}) p left join ({SCORED_TURNS}) s on s.record_id = p.record_id
        group by p.record_id""",
    "reward_avg_dataset": f"""
        select round(coalesce(
            (select sum(score) from ({SCORED_TURNS}))
            / nullif((select count(*) * 2 from ({ALL_PAIRS})), 0), 0), {DIGITS}) as avg_score""",
    "reward_report": f"""
        select p.record_id, coalesce(s.turn, 0) // 64 as part,
            case when s.score is not null then cast(row_number() over (
                partition by p.record_id, s.turn // 64 order by s.turn) - 1 as int) end as place,
            s.score, round(coalesce(avg(s.score) over (partition by p.record_id), 0), {DIGITS}) as avg_score
        from ({ALL_PAIRS}) p left join ({SCORED_TURNS}) s on s.record_id = p.record_id""",
    "reward_report_mean": f"""
        select round(coalesce(
            (select sum(score) from ({SCORED_TURNS}))
            / nullif((select count(*) * 2 from ({ALL_PAIRS})), 0), 0), {DIGITS}) as avg_score""",
    "reward_report_sampled": f"""
        select round(sum(s.score) / {SAMPLE_SIZE // 2 * 2}, {DIGITS}) as avg_score
        from ({_sample(ALL_PAIRS, str(SAMPLE_SIZE // 2))}) p
        left join ({SCORED_TURNS}) s on s.record_id = p.record_id""",
    "score_over_budget": f"""
        select record_id, turn, asked_units + answer_units > {SCORED_UNITS} as over_budget,
            {_score('asked', 'answer')} as score
        from (select *,
                case when answer_units + asked_units <= {SCORED_UNITS} then instruction
                    when answer_units >= {SCORED_UNITS} then ''
                    else array_to_string(asked_pieces[-({SCORED_UNITS} - answer_units):], '') end as asked,
                case when answer_units <= {SCORED_UNITS} then response
                    else array_to_string(answer_pieces[-{SCORED_UNITS}:], '') end as answer
            from (select *, len(asked_pieces) as asked_units, len(answer_pieces) as answer_units
                from (select *, regexp_extract_all(instruction, '\\S+\\s*') as asked_pieces,
                        regexp_extract_all(response, '\\S+\\s*') as answer_pieces from ({TURNS}))))""",
    "reward_report_budget": BUDGET_REPORT,
    "reward_report_budget_worker": BUDGET_REPORT,
    "reward_report_tokens": TOKEN_REPORT,
    "threshold_split": _with("select record_id, route from routed0", **PAIR_ROUNDS),
    "route_counts": _with(
        "select route, count(*) as n from routed0 group by route", **PAIR_ROUNDS
    ),
    "route_three_way": _with(
        f"select record_id, {_each('scores', 'score')}, route from routed0",
        **_rounds(GENERATED, CACHED_GAMMA, "min", cached=True),
    ),
    "sample_exact_fraction": _fraction(INSTRUCTIONS, FRACTION),
    "sample_fixed_size": _sample(INSTRUCTIONS, str(SAMPLE_SIZE)),
    "sample_repeated_ids": " union all ".join(
        f"select record_id, instruction, {share}::double as share from ({SHUFFLED}) where place < floor(n * {share}::double)"
        for share in SHARES
    ),
    "seeded_shuffle": f"select record_id, instruction, place from ({SHUFFLED})",
    "rubric_valid": f"select record_id, is_valid from ({READ_RUBRICS})",
    "rubric_parse": f"""
        select record_id, entry.criterion as criterion, entry.score as score, entry.note as note
        from (select record_id, unnest(entries) as entry from ({READ_RUBRICS}) where readable)""",
    "rubric_avg": f"""
        select record_id, case when readable then {_MEAN} end as avg_score
        from ({READ_RUBRICS})""",
    "first_valid_attempt": f"""
        select record_id, feedback, {_FLAT}, error from ({OUTCOMES}) o""",
    "keep_failed": f"""
        select g.record_id,
            case when g.instruction is not null and o.error is null then {_MEAN} end
                as feedback_avg_score,
            case when g.instruction is null then '{PARSE_FAILURE}'
                when o.error is not null then 'exception: ' || o.error
                when o.record_id is null then '{PARSE_FAILURE}' end as failure_reason
        from ({GAPS}) g left join ({OUTCOMES}) o on o.record_id = g.record_id""",
    "rubric_report": REPORT,
    "rubric_report_lines": f"""
        select i.record_id, i.instruction, case when o.error is null then {_MEAN} end as feedback_avg_score,
            case when o.error is not null then 'exception: ' || o.error
                when o.record_id is null then '{PARSE_FAILURE}' end as failure_reason
        from ({INSTRUCTIONS}) i left join ({OUTCOMES}) o on o.record_id = i.record_id
        union all
        select 'gap ' || record_id, null, null, '{PARSE_FAILURE}'
        from ({DOCUMENTS}) where source = 'src0' or lang in ('fr', 'es', 'de')""",
    "rubric_report_live": REPORT,
    "rubric_report_live_worker": REPORT,
    "rubric_report_counts": f"""
        select (select count(*) from ({REPORT})) as n_written,
            (select count(*) from documents) as n_total""",
    "generate_n": f"""
        select record_id, {_each()}, over_budget, cast(null as varchar) as error from ({GENERATED})""",
    "generate_n_worker": f"""
        select record_id, {_each()}, over_budget, cast(null as varchar) as error from ({GENERATED})""",
    "first_responses": f"""
        select record_id, {_each()}, over_budget, cast(null as varchar) as error
        from (select record_id, {_generated_texts('shown')} as responses, over_budget
            from (select *, {_head('instruction', _SHOWN)} as shown,
                    {_over('instruction', _SHOWN)} as over_budget
                from ({_fraction(GAPS, SAMPLE_FRACTION)})) s
            where instruction <> ''
                and not exists (select 1 from ({DONE}) d where d.instruction = s.instruction))""",
    "critique_rewrite": FIRST_CRITIQUES,
    "critique_rewrite_worker": FIRST_CRITIQUES,
    "refine_rounds": _with(_OUTCOME, **PAIR_ROUNDS),
    "refine_rounds_resumed": _with(_OUTCOME, **PAIR_ROUNDS),
    "refine_rounds_worker": _with(_OUTCOME, **PAIR_ROUNDS),
    "refine_rounds_budget": _with(
        " union all ".join(
            f"""select record_id, {_each('scores', 'score')}, {_each('flags', 'cut')}, {i} as round, route
            from routed{i}"""
            for i in range(MAX_ROUNDS)
        ),
        **_rounds(GENERATED, CACHED_GAMMA, "min", cached=False, budget=SCORED_UNITS),
    ),
    "refine_rounds_cached": _with(_OUTCOME, **DOCUMENT_ROUNDS),
    "round_counts": _with(
        " union all ".join(
            f"select {i} as round, route, count(*) as n from routed{i} group by route"
            for i in range(MAX_ROUNDS)
        ),
        **PAIR_ROUNDS,
    ),
    "refine_log": _with(
        f"""select record_id, round, from_cache, instruction, {_each()}, feedback,
            original_instruction, {_each('original_responses', 'original_response')},
            refined_instruction, {_each('refined_responses', 'refined_response')}, over_budget, error
        from ({' union all '.join(f'select * from log{i}' for i in range(MAX_ROUNDS))})""",
        **DOCUMENT_ROUNDS,
    ),
    "next_round_union": _with(
        f"select record_id, instruction, {_each()}, original_instruction from in1",
        **DOCUMENT_ROUNDS,
    ),
    "accepted_union": _with(
        f"""select record_id, round, instruction, {_each('scores', 'score')}
        from ended where status = 'accepted'""",
        **PAIR_ROUNDS,
    ),
    "final_products": _with(
        _both_sides("status in ('accepted', 'left')", "status,"), **PAIR_ROUNDS
    ),
    "finalized_products": _with(
        _both_sides("status in ('accepted', 'left')", "status,"), **PAIR_ROUNDS
    ),
    "export_in_input_order": _with(
        """select side, status, cast(seq as varchar) as record_id, seq,
            row_number() over (partition by side, status order by seq) - 1 as place
        from (select *, unnest(['original', 'refined']) as side from ended e join numbers n using (record_id)
            where status in ('accepted', 'left'))""",
        numbers=f"""select record_id, row_number() over (order by cast(record_id as bigint)) - 1 as seq
            from ({INSTRUCTIONS})""",
        **_rounds(GENERATED, CACHED_GAMMA, "min", cached=False),
    ),
    "left_products": _with(_both_sides("status = 'left'", ""), **DOCUMENT_ROUNDS),
    "conservation_check": _with(
        f"""select (select count(*) from in0) as n_input,
            count(*) filter (where status = 'accepted') as n_accepted,
            count(*) filter (where status = 'left') as n_left,
            count(*) filter (where status = 'invalid') as n_invalid,
            count(distinct record_id) = count(*)
                and count(*) = (select count(*) from in0) as whole
        from ended""",
        **PAIR_ROUNDS,
    ),
}
