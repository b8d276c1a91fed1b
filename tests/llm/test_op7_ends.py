"""Values that other digits or capitals follow."""

import pytest

from lexiflow.llm import pii


@pytest.mark.parametrize(
    "value, after, kind",
    [
        ("4111111111111111", " 123", "card"),
        ("4111-1111-1111-1111", " 05/27", "card"),
        ("4111-1111-1111-1111", "-1234", "card"),
        ("4111 1111 1111 1111", " 05 27", "card"),
        ("BE68 5390 0754 7034", " BIC", "iban"),
        ("BE68 5390 0754 7034", " WITH BIC", "iban"),
        ("BE68539007547034", " BIC", "iban"),
    ],
)
def test_values_end_before_what_follows(value, after, kind):
    text, spans = pii.Pseudonymiser("key").apply(f"pay {value}{after} now")
    assert spans == [(kind, 4, 4 + len(value))] and value not in text and text.endswith(f"{after} now")


def test_no_valid_end_keeps_the_text():
    for text in ("pay 4111111111111112 124 now", "pay BE69 5390 0754 7034 BIC now"):
        assert pii.Pseudonymiser("key").apply(text) == (text, [])
