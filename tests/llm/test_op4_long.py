"""Long texts are read back in little memory."""

import tracemalloc

import pytest

from lexiflow.llm import chat


def test_a_text_of_twenty_million_characters():
    said = "plain <text> \\\\ and more of it, " * 650_000
    formatted = f"### user: {chat.escape(said)}</turn>\n### assistant: ok</turn>\n"
    tracemalloc.start()
    turns = chat.read_turns(formatted)
    assert next(turns) == ("user", said) and next(turns) == ("assistant", "ok") and next(turns, None) is None
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(said) > 20_000_000 and peak < 300_000_000


@pytest.mark.parametrize("text", ["x", "### a: b", "### a b</turn>\n", "### a: b</turn>", "### a: b\\</turn>\n", "### a:b</turn>\n"])
def test_no_turn(text):
    with pytest.raises(ValueError, match="no turn at 0"):
        list(chat.read_turns(text))
