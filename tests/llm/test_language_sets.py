"""Sets of languages where one learned language is related to another, on made-up languages."""

import random

import numpy as np
import pytest

from tidemark.llm import language_id as li


def vocabulary(rng, letters):
    return ["".join(rng.choice(letters) for _ in range(rng.randint(3, 8))) for _ in range(400)]


@pytest.fixture(scope="module")
def made_up():
    """(model, texts): main and kin share most words, far shares none; ten others have all letters."""
    rng = random.Random(1)
    words = {"main": vocabulary(rng, "abcdefghijklmnop"), "far": vocabulary(rng, "klmnopqrstuvwxyz")} | {f"x{i}": vocabulary(rng, "abcdefghijklmnopqrstuvwxyz") for i in range(10)}
    words["kin"] = [w if rng.random() < 0.7 else w[::-1] for w in words["main"]]

    def text(shares, n):
        return " ".join(rng.choice(words[lang]) for lang, share in shares.items() for _ in range(round(n * share)))

    def model(langs):
        counts = np.array([np.bincount(li.trigram_cells(text({lang: 1}, 20_000)), minlength=li.CELLS) for lang in langs]).T
        return li.MixtureModel(list(langs), np.log((counts + 0.5) / (counts.sum(0) + 0.5 * li.CELLS)))

    return model, text


@pytest.mark.parametrize("share", [0.05, 0.1, 0.2])
def test_a_refused_relative_hides_no_language(made_up, share):
    model, text = made_up
    for _, _, sets in [model(["far", "kin", "main"]).infer([text({"main": 1 - share, "far": share}, 350) for _ in range(20)])]:
        assert all(set(s) == {"main", "far"} for s in sets)


def test_ten_languages_in_one_text(made_up):
    model, text = made_up
    langs = {f"x{i}": 0.1 for i in range(10)}
    _, _, (found,) = model(["far", "kin", "main", *langs]).infer([text(langs, 400)])
    assert set(found) == set(langs) and all(abs(s - 0.1) < 0.05 for s in found.values())


def test_every_language_pays_its_penalty(made_up):
    model, text = made_up
    fitted, texts = model(["far", "kin", "main"]), [text({"main": 0.7, "far": 0.3}, 350) for _ in range(20)]
    assert all(set(s) == {"main", "far"} for s in fitted.infer(texts)[2])


@pytest.mark.parametrize("share", [0.05, 0.1])
def test_a_relative_that_is_there_is_found(made_up, share):
    model, text = made_up
    fitted = model(["far", "kin", "main"])
    sets = fitted.infer([text({"main": 1 - share, "kin": share}, 1000) for _ in range(30)])[2]
    assert sum(set(s) == {"main", "kin"} for s in sets) >= 28


def plain_em(p, n, rounds=20_000):
    """Proportions after so many steps of expectation-maximisation, cell by cell."""
    pi = np.full(p.shape[1], 1 / p.shape[1])
    for _ in range(rounds):
        pi = (n[:, None] * p * pi / (p @ pi)[:, None]).sum(0) / n.sum()
    return pi, float((n * np.log(p @ pi)).sum())


def test_climbing_reaches_what_plain_estimation_does(made_up):
    model, text = made_up
    fitted = model(["far", "kin", "main"])
    texts = [text({"main": 0.9, "kin": 0.1}, 300), text({"main": 1.0}, 50), text({"far": 0.3, "kin": 0.7}, 400), "ab", text({"main": 0.02, "far": 0.98}, 500)]
    cells = [np.unique(li.trigram_cells(t), return_counts=True) for t in texts]
    p, n, size = np.concatenate([fitted.p[c] for c, _ in cells]), np.concatenate([k for _, k in cells]).astype(float), np.array([len(c) for c, _ in cells])
    start = np.full((len(texts), 3), 1 / 3)
    pi, value = fitted.climb(p, n, size, start, np.full(len(texts), 1e-4), np.full(len(texts), -np.inf))
    for i, (c, k) in enumerate(cells):
        want, most = plain_em(fitted.p[c], k.astype(float))
        assert most - 1e-3 <= value[i] <= most + 1e-3 and np.abs(pi[i] - want).max() < 0.02
    low = fitted.climb(p, n, size, start, np.full(len(texts), 1e-4), value + 1)[1]
    assert (low <= value + 1e-3).all()  # refused early, never above the greatest
