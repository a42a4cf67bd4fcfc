
import random
import string
import time

from hourlake.llm import secrets


def test_keys_beside_text():
    encoding = secrets._encoding(*secrets._vocabulary(None, None))
    found = lambda text: [text[a:b] for a, b, k in secrets.find_spans(text, encoding, 2.0)[1] if k == "random"]
    rng = random.Random(4)
    key = lambda n, letters: "".join(rng.choice(letters) for _ in range(n))
    for letters in (string.ascii_letters, string.ascii_lowercase):
        assert sum(bool(found(key(32, letters))) for _ in range(200)) >= 180
    for before in ("services/production/configuration/", "the_internal_service_configuration_"):
        keys = [key(24, string.ascii_letters + string.digits) for _ in range(200)]
        assert sum(found(before + k) == [k] for k in keys) >= 190
        assert sum(found(before + k + "/of/the/production/services") == [k] for k in keys) >= 190
    assert sum(any(k in f for f in found("key=" + k)) for k in keys) >= 190
    k = "zX9qK2vB7tLmP4wR8sYc"
    assert found("id/123e4567-e89b-12d3-a456-426614174000/" + k) == ["/" + k]  # a UUID cuts a run
    assert found("0123456789abcdef" + "/" + k + "==") == ["/" + k + "=="]  # so does a base span
    assert found("A1B2C3D4" * 5 + "/" + k) == ["/" + k]  # and a digest
    assert found("a/wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY")  # separators inside a key
    for text in ("getElementsByClassNameAndTagName", "services/production/configuration/of/the/day", "a-b-c-d-e-f-g-h-i-j-k-l",
                 "2024-05-12-10-30-22-000000", "-" * 40, "antidisestablishmentarianism", "item_2024_of_12_in_the_list",
                 "x/123e4567-e89b-12d3-a456-426614174000", "A1B2C3D4" * 5):
        assert found(text) == []
    start = time.time()
    for long in ("a1B_the_configuration_" * 10_000, "zX9qK2v/" * 25_000, "q7_" * 60_000, "zX9q_7_7_7_the_production_" * 8_000, "7_" * 90_000):
        found(long)
    assert time.time() - start < 20


def test_segments():
    rng = random.Random(1)
    for _ in range(300):
        scores = [rng.choice([-3, -1, 0, 1, 2]) for _ in range(rng.randint(0, 12))]
        got = secrets._top_segments(scores)

        def best(lo, hi):  # by definition: the best run, the shortest of equals, then what is beside it
            runs = [(sum(scores[a:b]), a - b, a, b) for a in range(lo, hi) for b in range(a + 1, hi + 1)]
            top = max(runs, default=(0, 0, 0, 0), key=lambda r: r[:2])
            return [] if top[0] <= 0 else best(lo, top[2]) + [(top[2], top[3] - 1)] + best(top[3], hi)

        assert sum(sum(scores[a:b + 1]) for a, b in got) == sum(sum(scores[a:b + 1]) for a, b in best(0, len(scores)))
