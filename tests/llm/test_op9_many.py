"""Texts in more than three languages keep all of them."""

import numpy as np

from lexiflow.llm import langid


def test_text_in_four_languages():
    words = {"aa": "tapo", "bb": "wexu", "cc": "zibi", "dd": "qurk"}
    counts = np.stack([np.bincount(langid.trigrams([w])[0], minlength=langid.PLACES) * 1000 for w in words.values()])
    text = " ".join(" ".join([w] * 50) for w in words.values())
    (_, share, found), = langid.Mixture(list(words), counts).infer([text])
    assert set(found) == set(words) and abs(share - 0.25) < 0.02
