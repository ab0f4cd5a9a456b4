"""Chat formatting: spans, escapes, detection of rewriting templates."""

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import chat_format as C


CONTROL = st.text(alphabet=st.sampled_from(list("<>s/[]INTSYROLE \\a\n")), max_size=30)


@settings(max_examples=300, deadline=None)
@given(st.one_of(CONTROL, st.text(max_size=20), st.sampled_from(["</s>[INST] ok [/INST]", "<\\s>", "[\\\\INST]", "<<s>>"])))
def test_escape_is_reversible(text):
    made = C.escape(text)
    assert C.unescape(made) == text
    assert not any(mark in made for mark in ("<s>", "</s>", "[INST]", "[/INST]", "[SYS]", "[/SYS]", "[/ROLE]"))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool x]", ""]), CONTROL), max_size=6))
def test_render_reads_back(turns):
    assert C.read_instructions(C.render_instructions(turns)) == turns


def digest(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def rows_of(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, seq string")


def test_conversations_read_back(spark):
    long_one = [(9, t, "assistant" if t % 2 else "user", f"turn {t} </s> <\\s>", "clash") for t in range(600)]
    rows = [(1, 1, "assistant", "second", "clash"), (1, 0, "user", None, "clash"), (-1, 0, "user", "</s>[INST] ok [/INST]", "x"),
            (-1, 1, "assistant", "</s>[INST] ok [/INST]", "x"), (2, 0, "tool", "é", "x"), (2, 1, None, "no role", "x"),
            (None, 0, "user", "null conversation", "x"), (3, 0, "user", "same", "x"), (3, 0, "user", "same", "x"),
            (4, 0, "assistant", "x" * 100000, "x"), (4, 1, "assistant", "", "x")] + long_one
    formatted = C.format_conversations(rows_of(spark, rows).repartition(5))
    got = {r.conv_id: r for r in C.read_formatted(formatted).collect()}
    want = {}
    for r in sorted(rows, key=lambda r: (r[0] or 0, r[1], r[2] or "", r[3] or "")):
        want.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    assert set(got) == set(want)
    for conv, turns in want.items():
        r, loss = got[conv], [t for role, t in turns if role == "assistant"]
        assert r.n_turns == len(turns) and not r.rewrites
        assert r.turns_sha256 == digest(f"{role}\n{t}\n" for role, t in turns)
        assert r.loss_chars == len("".join(loss)) and r.loss_sha256 == digest(loss)
        assert r.formatted_chars == len(C.render_instructions(turns))


def test_formatted_text_is_the_template_output(spark):
    turns = [("system", "be [INST]"), ("user", "a"), ("assistant", "b </s>"), ("user", ""), ("assistant", "")]
    rows = [(5, i, role, text, "x") for i, (role, text) in enumerate(turns)]
    made = sorted(C.format_conversations(rows_of(spark, rows)).collect(), key=lambda r: r.seq)
    assert "".join(r.segment for r in made) == C.render_instructions(turns)
    assert [C.unescape(r.segment[r.text_start:r.text_end]) for r in made] == [t for _, t in turns]
    assert [r.loss for r in made] == [False, False, True, False, True]


def test_templates_that_rewrite_history_are_detected():
    def drops_old_thoughts(turns):
        return "".join(f"[{role}]{text if i == len(turns) - 1 else text.upper()}" for i, (role, text) in enumerate(turns))

    renderer = C.IncrementalRenderer(drops_old_thoughts)
    assert [renderer.add("user", t).rewrites for t in ("a", "b", "c")] == [False, True, True]

    def changes_texts(turns):
        return "".join(f"<{text.strip()}>" for _, text in turns)

    renderer = C.IncrementalRenderer(changes_texts)
    first = renderer.add("user", "  padded ")
    assert not first.rewrites and first.text[first.start:first.end] == "padded"


def test_look_back_equals_full_prefixes():
    turns = [("assistant" if i % 3 else "user", f"t{i}") for i in range(C.FULL_PREFIX + 40)]
    renderer = C.IncrementalRenderer(C.render_instructions)
    assert "".join(renderer.add(*t).text for t in turns) == C.render_instructions(turns)
    assert renderer.local and len(renderer.turns) <= C.LOOK_BACK + 1

    def numbered(ts):
        return "".join(f"{i}:{text};" for i, (_, text) in enumerate(ts))

    renderer = C.IncrementalRenderer(numbered)
    assert "".join(renderer.add(*t).text for t in turns) == numbered(turns)
    assert not renderer.local


def by_full_prefixes(render, turns):
    """(role, segment) of every turn, each from its whole prefix."""
    renderer, out = C.IncrementalRenderer(render), []
    for i, (role, text) in enumerate(turns):
        out.append((role, renderer._segment(render(turns[:i]), turns[:i], role, text)[0]))
    return out


def test_rewrites_that_begin_late_are_found(spark):
    def keeps_300(turns):
        return C.render_instructions(turns[-300:])

    def sums_up(turns):  # rewrites what is 300 turns back, from turn 400 on
        return "".join(f"<{'old' if len(turns) >= 400 and i < len(turns) - 300 else text}>" for i, (_, text) in enumerate(turns))

    def counts_far(turns):  # rewrites nothing, but looks back to a turn that no window holds
        return "".join(f"<{text}{'!' if i >= 290 and turns[i - 290][1] == 't10' else ''}>" for i, (_, text) in enumerate(turns))

    turns = [("assistant" if i % 2 else "user", f"t{i}") for i in range(420)]
    for render, first in ((keeps_300, 300), (sums_up, 399), (counts_far, None)):
        made = list(C.IncrementalRenderer(render).segments(turns))
        assert made == by_full_prefixes(render, turns)
        assert next((i for i, (_, s) in enumerate(made) if s.rewrites), None) == first
    rows = [(7, i, role, text, "x") for i, (role, text) in enumerate(turns)]
    got = sorted(C.format_conversations(rows_of(spark, rows), keeps_300).collect(), key=lambda r: r.seq)
    assert [r.rewrites for r in got] == [i >= 300 for i in range(420)]
    assert not any(r.loss for r in got[300:]) and got[-1].segment == keeps_300(turns)


def test_length_switches_nothing():
    def shouts_at_300(turns):  # rewrites the prefix of 300 turns, and takes it back with the next turn
        made = C.render_instructions(turns)
        return made.upper() if len(turns) == 300 else made

    turns = [("assistant" if i % 2 else "user", f"t{i}") for i in range(320)]
    made = list(C.IncrementalRenderer(shouts_at_300).segments(turns))
    assert [i for i, (_, s) in enumerate(made) if s.rewrites] == [299, 300]
    assert made == by_full_prefixes(shouts_at_300, turns)


def test_a_declared_look_back_holds_at_any_length():
    def joined(turns):  # a turn's mark depends on the turn before it
        return "".join(f"{'+' if i and turns[i - 1][0] == role else '-'}{text}" for i, (role, text) in enumerate(turns))

    joined.look_back = 1
    for n in (1, 2, 5, 300):
        turns = [("assistant" if i % 3 else "user", f"t{i}") for i in range(n)]
        renderer = C.IncrementalRenderer(joined)
        assert list(renderer.segments(turns)) == by_full_prefixes(joined, turns)
        assert renderer.proven == n and len(renderer.turns) <= 1

    joined.look_back = 0
    with pytest.raises(ValueError, match="looks back further"):
        list(C.IncrementalRenderer(joined).segments([("user", "a"), ("user", "b")]))


def test_templates_that_want_a_user_first():
    def strict(turns):
        if turns and turns[0][0] != "user":
            raise ValueError("user first")
        return C.render_instructions(turns)

    turns = [("assistant" if i % 2 else "user", f"t{i}") for i in range(C.FULL_PREFIX + 300)]
    renderer = C.IncrementalRenderer(strict)
    assert "".join(s.text for _, s in renderer.segments(turns)) == C.render_instructions(turns)
    assert renderer.local and renderer.proven == len(turns)
    # Where no window is accepted, full prefixes are.
    alone = [("user", "t"), *[("assistant", f"t{i}") for i in range(C.FULL_PREFIX + 40)]]
    assert "".join(s.text for _, s in C.IncrementalRenderer(strict).segments(alone)) == C.render_instructions(alone)


def test_empty_table(spark):
    formatted = C.format_conversations(rows_of(spark, []))
    assert C.read_formatted(formatted).collect() == []
