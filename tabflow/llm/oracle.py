"""DuckDB SQL for the registered queries that SQL can express. The others
(edit distance, Feistel rounds, tokenizers, trained models, packing) are held
against brute force in tests/llm."""

from tabflow.llm.line_dedup import MIN_CHARS, MIN_DOCS
from tabflow.llm.queries import GOOD, MAX_EPOCHS, MIX_SEED, POOR, SOURCE_WEIGHTS, TAMPERED_ONE_IN, UNLABELLED
from tabflow.llm.spelling import CORRUPT_ONE_IN, FORM_FACTOR
from tabflow.llm.spelling import MIN_CHARS as LEAST_LETTERS
from tabflow.llm.spelling import MIN_COUNT as LEAST_COUNT
from tabflow.llm.quality_rules import (
    BASE_MIN_WORDS,
    BASE_REPEAT_PERCENT,
    LANGUAGES,
    RULES,
    STOP_FORMS,
    STOP_WORD_MIN_WORDS,
    SYMBOLS,
    WINDOW,
)

_WORDS = r"list_filter(string_split_regex(coalesce(text, ''), '[\x09-\x0D\x20]+'), lambda w: w <> '')"
_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _quality() -> str:
    stop = ", ".join(f"'{w}'" for w in STOP_FORMS)
    known = ", ".join(f"'{code}'" for code in LANGUAGES)
    fails = [f"coalesce({r.metric} < {r.low}, false)" for r in RULES if r.low is not None]
    fails += [f"coalesce({r.metric} > {r.high}, false)" for r in RULES if r.high is not None]
    return rf"""
with d as (
    select doc_id, {_WORDS} as words, coalesce(text, '') as body,
        coalesce(lower(split_part(lang, '-', 1)) in ({known}), false) as known,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x09-\x0D\x20]')) as lines
    from documents
), grams as (
    select doc_id, i, array_to_string(words[i : i + {WINDOW - 1}], ' ') as gram
    from (select doc_id, words, unnest(range(1, len(words) - {WINDOW - 2})) as i from d)
), repeated as (
    select doc_id, i from grams qualify count(*) over (partition by doc_id, gram) > 1
), covered as (
    select doc_id, count(distinct i + k) as n
    from (select doc_id, i, unnest(range({WINDOW})) as k from repeated) group by doc_id
), counts as (
    select d.doc_id, d.known, len(words) as n_words,
        length(regexp_replace(body, '[\x09-\x0D\x20]', '', 'g')) as word_chars,
        length(body) - length(regexp_replace(body, '[{SYMBOLS}]', '', 'g')) as n_symbols,
        len(lines) - len(list_distinct(lines)) as n_dup_lines,
        coalesce(covered.n, 0) as n_repeat_words,
        len(lines) as n_lines,
        len(list_filter(words, lambda w: list_contains([{stop}], w))) as n_stop_words,
        length(body) - length(replace(body, '!', '')) as n_exclamations
    from d left join covered on d.doc_id = covered.doc_id
), ratios as (
    select *,
        case when n_words > 0 then word_chars / n_words else 0 end as mean_word_chars,
        case when n_words > 0 then n_symbols / n_words else 0 end as symbol_ratio,
        case when n_words > 0 then n_exclamations / n_words else 0 end as exclamation_ratio,
        case when known and n_words >= {STOP_WORD_MIN_WORDS} then n_stop_words / n_words end as stop_word_ratio,
        case when n_lines > 0 then n_dup_lines / n_lines else 0 end as dup_line_ratio,
        n_words < {BASE_MIN_WORDS} or 100 * n_repeat_words > {BASE_REPEAT_PERCENT} * n_words as base_failed
    from counts
)
select doc_id, n_words::bigint as n_words, word_chars::bigint as word_chars, n_symbols::bigint as n_symbols,
    n_dup_lines::bigint as n_dup_lines, n_repeat_words::bigint as n_repeat_words, base_failed,
    not base_failed and not ({" or ".join(fails)}) as kept
from ratios
"""


_NEAR = rf"""
with recursive words as (
    select doc_id, list_transform({_WORDS}, lambda w: translate(w, {_LOWER})) as words from documents
), shingles as (
    select distinct doc_id, array_to_string(words[i : i + 2], ' ') as shingle
    from (select doc_id, words, unnest(range(1, greatest(len(words) - 1, 2))) as i from words where len(words) > 0)
), sizes as (
    select doc_id, count(*) as n from shingles group by doc_id
), shared as (
    select a.doc_id as a, b.doc_id as b, count(*) as n
    from shingles a join shingles b on a.shingle = b.shingle and a.doc_id < b.doc_id group by a.doc_id, b.doc_id
), links as (
    select a, b from shared join sizes x on x.doc_id = a join sizes y on y.doc_id = b
    where 100 * shared.n >= 85 * (x.n + y.n - shared.n)
), both_ways as (
    select a, b from links union select b, a from links
), reached(doc_id, other) as (
    select a, b from both_ways union select r.doc_id, e.b from reached r join both_ways e on r.other = e.a
)
select d.doc_id, coalesce(s.n, 0) as n_shingles, least(d.doc_id, coalesce(r.low, d.doc_id)) as component_id,
    d.doc_id <= coalesce(r.low, d.doc_id) as kept
from documents d left join sizes s on s.doc_id = d.doc_id
left join (select doc_id, min(other) as low from reached group by doc_id) r on r.doc_id = d.doc_id
"""

_LINES = rf"""
with lines as (
    select doc_id, line, pos, translate(trim(line, {_SPACES}), {_LOWER}) as key
    from (select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
        generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos from documents)
), common as (
    select key, max(doc_id) as last_doc from lines where length(key) >= {MIN_CHARS}
    group by key having count(distinct doc_id) >= {MIN_DOCS}
), marked as (
    select lines.*, common.key is not null and lines.doc_id <> last_doc as gone
    from lines left join common on lines.key = common.key
)
select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
    sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not gone), '')) as kept_sha256
from marked group by doc_id
"""


def _crc32(text: str) -> str:
    """crc32 of the UTF-8 bytes of a text, bit by bit."""
    data = f"hex(encode({text}))"
    octets = f"list_transform(range(0, length({data}), 2), lambda p: ('0x' || {data}[p + 1 : p + 2])::bigint)"
    bits = "list_reduce(list_prepend(xor(c, o), [0, 0, 0, 0, 0, 0, 0, 0]), lambda x, z: xor(x >> 1, (x & 1) * 3988292384))"
    return f"xor(list_reduce(list_prepend(4294967295::bigint, {octets}), lambda c, o: {bits}), 4294967295)"


def _mix() -> str:
    weights = f"[{', '.join(map(str, SOURCE_WEIGHTS))}]"
    return rf"""
with recursive quality as (
    select doc_id, max(quality) as quality from labels group by doc_id
), d as (
    select documents.doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
        -ln((('0x' || md5('{MIX_SEED}:' || coalesce(documents.doc_id::varchar, '-') || ':' || md5(coalesce(text, '')))[1:13])::bigint + 0.5)
            / {float(16**13)}) / case quality when 1 then {GOOD} when 0 then {POOR} else {UNLABELLED} end as key
    from documents left join quality on documents.doc_id = quality.doc_id
), s as (
    select source, sum(size)::hugeint as size, {weights}[(row_number() over (order by source nulls last) - 1) % {len(SOURCE_WEIGHTS)} + 1]::hugeint as weight
    from d group by source
), rounds(shared, among, step) as (
    select sum(size)::hugeint, sum(weight)::hugeint, 0 from s
    union
    select * from (
        select (select sum(size) from s) - coalesce(sum({MAX_EPOCHS} * size) filter ({MAX_EPOCHS} * size * among <= weight * shared), 0) as shared,
            coalesce(sum(weight) filter ({MAX_EPOCHS} * size * among > weight * shared), 0)::hugeint as among, any_value(step) + 1
        from s, rounds where step < 1000 group by shared, among
    ) where among > 0
), last as (
    select shared, among from rounds order by among, step limit 1
), t as (
    select source, size as source_size, case when {MAX_EPOCHS} * size * among <= weight * shared then ({MAX_EPOCHS} * size)::double
        else (weight * shared)::double / among::double end as target from s, last
), placed as (
    select doc_id, size, source_size, target, least(floor(target / nullif(source_size, 0)), {MAX_EPOCHS}) as epochs,
        sum(size) over (partition by d.source order by key, doc_id nulls first, size rows unbounded preceding) - size as before
    from d join t on d.source is not distinct from t.source
)
select doc_id, size, source_size::bigint as source_size, target, (size * (coalesce(epochs, 0) + case when epochs < {MAX_EPOCHS}
    and 2 * before + size <= 2 * (target - epochs * source_size) then 1 else 0 end))::bigint as taken
from placed
"""


def _manifest() -> str:
    upper, lower = _LOWER.split(", ")
    fields = lambda text: " || ".join(
        f"coalesce(octet_length(encode({c}))::varchar || ':' || {c}, '-')"
        for c in ("doc_id::varchar", "source", "lang", "n_chars::varchar", text)
    )
    return f"""
with recursive leaves as (
    select doc_id, lang, sha256({fields("text")}) as leaf, sha256({fields("seen")}) as seen
    from (select *, case when {_crc32("doc_id::varchar")} % {TAMPERED_ONE_IN} = 0 then translate(text, {upper}, {lower}) else text end as seen
        from documents)
), placed as (
    select *, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as i, count(*) over (partition by lang) as n from leaves
), nodes(level, lang, i, n, digest) as (
    select 0, lang, i, n, leaf from placed
    union all
    select any_value(level) + 1, lang, i // 8, (any_value(n) + 7) // 8, sha256(string_agg(digest, '' order by i))
    from nodes where n > 1 group by lang, i // 8
), subroots as (
    select lang, digest as subroot, level as height, row_number() over (order by lang nulls first) - 1 as i, count(*) over () as n
    from nodes where n = 1
), tops(level, i, n, digest) as (
    select 0, i, n, subroot from subroots
    union all
    select any_value(level) + 1, i // 8, (any_value(n) + 7) // 8, sha256(string_agg(digest, '' order by i)) from tops where n > 1 group by i // 8
), ways as (
    select doc_id, p.leaf, seen, p.lang, p.i, s.level as level, s.i as other, s.digest, p.i // (8 ** s.level)::bigint as own
    from placed p join nodes s on s.lang is not distinct from p.lang and s.n > 1 and s.i // 8 = p.i // (8 ** (s.level + 1))::bigint
    union all
    select doc_id, p.leaf, seen, p.lang, p.i, r.height + t.level, t.i, t.digest, r.i // (8 ** t.level)::bigint
    from placed p join subroots r on r.lang is not distinct from p.lang
    join tops t on t.n > 1 and t.i // 8 = r.i // (8 ** (t.level + 1))::bigint
), steps as (
    select lang, i, level, coalesce(string_agg(digest, '' order by other) filter (other < own), '') as before,
        coalesce(string_agg(digest, '' order by other) filter (other > own), '') as after
    from ways group by lang, i, level
), folds(lang, i, level, digest) as (
    select lang, i, 0, seen from placed
    union all
    select f.lang, f.i, f.level + 1, sha256(before || digest || after)
    from folds f join steps s on s.lang is not distinct from f.lang and s.i = f.i and s.level = f.level
), proofs as (
    select lang, i, sha256(string_agg(before || after, '' order by level)) as proof, max(level) + 1 as height from steps group by lang, i
)
select doc_id, leaf, subroot, (select digest from tops where n = 1) as root, coalesce(proof, sha256('')) as proof_sha256,
    f.digest as folded_root, f.digest = (select digest from tops where n = 1) as verified
from placed p join subroots r on r.lang is not distinct from p.lang
left join proofs o on o.lang is not distinct from p.lang and o.i = p.i
join folds f on f.lang is not distinct from p.lang and f.i = p.i and f.level = coalesce(o.height, 0)
"""


def _spelling() -> str:
    upper, lower = _LOWER.split(", ")
    crc = _crc32("doc_id::varchar || ':' || run")
    return f"""
with recursive runs as (
    select doc_id, run, count(*) as n from (
        select doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')), {upper}, {lower}) as run from documents
    ) where length(run) >= {LEAST_LETTERS} group by doc_id, run
), hashed as (
    select run, n, {crc} as h from runs
), w as (
    select word, sum(n)::bigint as n from (
        select n, case when h % {CORRUPT_ONE_IN} = 0 then left(run, (h % length(run))::int) || substr(run, (h % length(run))::int + 2) else run end as word from hashed
    ) where length(word) >= {LEAST_LETTERS} group by word having sum(n) >= {LEAST_COUNT}
), cuts as (
    select word, p, left(word, p) || substr(word, p + 2) as rest from (select word, unnest(range(length(word)::int))::int as p from w)
), pairs as (
    select a.word, b.word as near from cuts a join cuts b on a.rest = b.rest and a.p = b.p and a.word <> b.word
    union select cuts.word, w.word from cuts join w on cuts.rest = w.word
    union select w.word, cuts.word from cuts join w on cuts.rest = w.word
), linked as (
    select p.word, count(*) as n_near, first(p.near order by o.n desc, p.near) as best, max(o.n) as best_n
    from pairs p join w o on o.word = p.near group by p.word
), forms as (
    select w.word, w.n, coalesce(n_near, 0) as n_near, case when best_n >= {FORM_FACTOR} * w.n then best end as form,
        case when best_n >= {FORM_FACTOR} * w.n then best_n end as form_n
    from w left join linked on linked.word = w.word
), ways(word, root) as (
    select word, word from forms union all select ways.word, forms.form from ways join forms on forms.word = ways.root where form is not null
), ends as (
    select ways.word, ways.root from ways join forms on forms.word = ways.root where form is null
)
select forms.word, n, n_near::bigint as n_near, form, form_n, root from forms join ends on ends.word = forms.word
"""


ORACLE_SQL: dict[str, str] = {
    "op3_quality_rules": _quality(),
    "op5_minhash": _NEAR,
    "op9_line_dedup": _LINES,
    "op11_mixing": _mix(),
    "op12_spelling": _spelling(),
    "op13_manifest": _manifest(),
}
