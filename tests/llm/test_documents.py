"""Tokens, containers and spam pages."""

import base64
import random
import time

import numpy as np
import pytest

from trajecta.llm import bpe, containers, spam

SCHEMA = "doc_id bigint, text string, n_tokens string, key string, shape string"
HARD = ["aaaaaaa" * 50, "    \n\n  x", " " * 1000, "😀" * 300, "ab" * 5000, "<|endoftext|> <|startoftext|>", "你好" * 4000, "\r\n\r\n", "á ß ſ é", "'s't're''", "\x00\x01", "1234567890" * 30, "don't DON'T", "　  x"]


@pytest.fixture(scope="module")
def public():
    tokens = pytest.importorskip("public_tokenizers")
    tiktoken = pytest.importorskip("tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(tokens.path("byte_bpe_50k.tiktoken"), "rb"))}
    return tiktoken.Encoding("own", pat_str=tokens.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def documents(spark, texts):
    return spark.createDataFrame([(k, t, "a", "b", "c") for k, t in enumerate(texts)], SCHEMA)


def test_tokens(spark, public):
    rng = random.Random(0)
    texts = [None, "", *HARD, *["".join(rng.choice("ab eé你\n1,'s ") for _ in range(rng.randint(1, 80))) for _ in range(200)]]
    got = {r.doc_id: r.ids for r in bpe.token_ids(documents(spark, texts)).collect()}
    assert all(got[k] == (public(t) if t else []) for k, t in enumerate(texts))
    assert bpe.token_ids(documents(spark, texts).limit(0)).count() == 0


def test_words_are_forgotten(public, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    e = bpe.Encoder(*bpe.read_vocabulary())
    for _ in range(3):
        assert [x for x in e.encode(HARD)] == [public(t) for t in HARD]


def test_containers(spark, public):
    rng = random.Random(1)
    texts = [None, "", "word " * 5000, "word " * 2048, *[("some words here " * 400)[: rng.randint(0, 4000)] for _ in range(300)], *["same text"] * 50]
    df = documents(spark, texts)
    out = containers.containers(df).collect()
    size = {k: len(public(t)) if t else 0 for k, t in enumerate(texts)}
    room, covered = {}, {}
    for r in out:
        room[r.container_id] = room.get(r.container_id, 0) + r.n_tokens
        covered.setdefault(r.doc_id, []).append((r.first_token, r.n_tokens, r.piece))
    assert max(room.values()) <= containers.CAPACITY
    assert set(covered) == set(size)
    for k, n in size.items():
        parts = sorted(covered[k])
        assert len(parts) == 1 or n > containers.CAPACITY
        assert [p for *_, p in parts] == list(range(len(parts))) and parts[0][0] == 0 and sum(m for _, m, _ in parts) == n
        assert all(a + m == b for (a, m, _), (b, _, _) in zip(parts, parts[1:]))
    assert len(room) <= -(-sum(size.values()) // containers.CAPACITY) * 1.1 + 1
    assert containers.containers(df.limit(0)).count() == 0
    assert containers.fill_report(containers.containers(df)).head().containers == len(room)
    assert len(containers.containers(df.where("doc_id < 2")).collect()) == 2


def test_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(containers, "TOKENS_A_TASK", 3000)
    df = documents(spark, ["a few words " * k for k in range(1, 120)] + ["same text"] * 200)
    out = containers.containers(df).collect()
    assert len(out) == 319
    room = {}
    for r in out:
        room[r.container_id] = room.get(r.container_id, 0) + r.n_tokens
    assert max(room.values()) <= containers.CAPACITY


def test_hilbert():
    bits = 3
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * 3, indexing="ij"), -1).reshape(-1, 3)
    key = containers.hilbert_key(cells, bits)
    assert sorted(key.tolist()) == list(range(len(cells)))
    path = cells[np.argsort(key)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()  # neighbours on the curve are neighbours in space


PROSE = "The arm moved the cup to the shelf, and nobody touched it. We stopped the run early, because the camera was late. "
SPAM = [
    "buy gripper, cheap gripper, robot arm price, best cobot, gripper shop, servo sale " * 3,
    "#gripper #usedcobot #servomotor #buyarm #cheaprail #cupcup",
    "https://a.example/x https://b.test/y?id=3 http://www.c.invalid/z/",
    "* servo: https://a.example/x\n* rail: https://b.test/y\n* cup: https://c.test/z",
    '<a href="https://a.example/">cheap arm</a> | <a href="https://b.test/">buy rail</a>',
    "[servo](https://a.example/) | [rail](https://b.test/q)",
    "SKU-1 | linear rail | in stock | EUR 8.20\nSKU-2 | servo | new | EUR 9.10",
    "cheap arm;blue;M;20.10\nbuy rail;red;L;31.99\nservo shop;wet;S;12.00",
    "Looking for cheap arm? Our cheap arm is the best cheap arm, better than any used arm. cheap arm, used arm and cheap arm: order your cheap arm now!",
    "Cheap arm buy rail cheap arm cheap arm buy rail. Buy rail buy rail cheap arm servo servo cheap arm!",
    "力传感器, 毛巾价格, 机械臂, 力传感器, 吸盘, 毛巾价格",
    "servo (12) rail price (40) buy cup (3) arm shop (77)",
    PROSE + "\n\n" + "buy gripper | cheap gripper | arm price | used cobot | servo sale | " * 8,
]
FINE = [
    PROSE, PROSE * 40, PROSE + "\n\nTags: cup, shelf, arm, camera, run, late", PROSE + "\nLinks\n- https://a.example/x",
    "[step 000123] loss=1.23 dynamics=0.4\n[step 000133] loss=1.22 dynamics=0.4", '{"step": 1, "loss": 2.0}\n{"step": 2, "loss": 1.9}', "12\t1.04\trb-03\tok\n22\t1.03\trb-04\tok",
    "state:\n  - {original_key: observation.state, start: 1, end: 3}", "    for k in range(9):\n        pose[k] += 0.5 * (goal[k] - pose[k])", "- Check the left camera before the run.\n- Close the gripper and wait for the light.\n3. Write down the number of the run.",
    "Operator: A bit to the left, please.\nRobot: Hold it there.\nOperator: Now it is fine.", "视频显示右臂没有回到原位。误差约为1.50厘米，比上周小。", None, "", " \n", " ",
]


def test_spam(spark):
    df = documents(spark, SPAM + FINE)
    got = {r.doc_id for r in spam.flagged(df.unionByName(df)).collect()}
    assert got == set(range(len(SPAM)))
    assert spam.flagged(spark.createDataFrame([(None, SPAM[0]), (3, SPAM[0] * 20_000)], "doc_id bigint, text string")).collect() == [(3,)]
    assert spam.flagged(df.limit(0)).count() == 0


def test_shares_add_up(spark):
    p = spam.pages(documents(spark, [*SPAM, *FINE])).collect()
    assert all(0 <= r.other_chars <= r.chars for r in p)
    assert all(r.main_shape is not None for r in p if r.other_chars)


@pytest.mark.parametrize(
    "line",
    [
        lambda n: "-" + " " * n + "x", lambda n: "<a x>" * n + "/", lambda n: "[" * n + "](/", lambda n: "? " * n, lambda n: "a? " * n, lambda n: "a-" * n + "/", lambda n: "a." * n + "/ ", lambda n: "a | b | c" + " " * n + "d | e", lambda n: "a | b | c" + "\t" * n + "d",
        lambda n: "(" * n + "1" * n, lambda n: "." + '"' * n + "x", lambda n: '"' + " " * n + "x", lambda n: ".)" * n, lambda n: "a'" * n, lambda n: "<br " * n + " | ; | ; ", lambda n: "<a x><b>" * n + "</a>/", lambda n: "![" * n + "/](", lambda n: "] " * n + "|;", lambda n: " -" * n + " |;", lambda n: "a|b|c" + " " * n + "d",
    ],
)
def test_time_of_a_line_grows_with_its_length_only(line):
    def seconds(n):
        text, best = line(n), float("inf")
        for _ in range(3):
            began = time.perf_counter()
            spam.segments(text)
            best = min(best, time.perf_counter() - began)
        return best

    assert seconds(32000) < 10 * seconds(8000) + 0.3  # four times the length; squared it would be 16


def test_few_shapes_decide():
    """The same characters in many kinds of shapes are no spam, in few they are."""
    link = "[buy this now](http://x.example/abc)"
    assert spam.page("\n".join([link] * 20))[3] > 0.9 * spam.page("\n".join([link] * 20))[0]
    mixed = [("list/few/lower", False, 10), *[(f"label/few/{k}", False, 10) for k in range(20)], ("sentence/line/few", True, 30)]
    few = sorted((n for _, s, n in mixed if not s), reverse=True)[: spam.FEW]
    assert sum(few) < spam.SHARE * sum(n for *_, n in mixed) < sum(n for _, s, n in mixed if not s)
    assert spam.page("") == (0, 0, 0, 0, None)
