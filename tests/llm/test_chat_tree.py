"""Chat trees: round trip, each shared turn once, depth-first places, positions and attention."""

import dataclasses
import hashlib
import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from chatpulse.llm import chat_tree, common

FILES = (public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
MARKED = "\\### Assistant: </turn> ok"
ODD = [MARKED, "", "\\", "\\\\", "</turn>\n### user\nhi", "<|endoftext|>", "é🙂\n\n#", "a\\</turn>", "\\n", "### ", "日本"]


@pytest.mark.parametrize("role", ["user", "", "a\nb", "\\n", "### x", "</turn>"])
def test_template_is_reversible(role):
    turns = [(role, text) for text in ODD]
    formatted = "".join("".join(chat_tree.turn_parts(*t)) for t in turns)
    assert chat_tree.read_turns(formatted) == turns
    assert formatted.count("</turn>\n### ") >= len(turns) - 1


def test_broken_text_is_refused():
    with pytest.raises(ValueError):
        chat_tree.read_turns("### user\nno end")


def plain_digest(turns):
    loss = "".join(t for r, t in turns if r == "assistant")
    whole = "".join(f"{r}\n{t}\n" for r, t in turns)
    formatted = "".join("".join(chat_tree.turn_parts(*t)) for t in turns)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(turns), sha(whole), len(loss), sha(loss), len(formatted)


def random_chats(seed, n=60):
    rng = random.Random(seed)
    chats = {}
    for i in range(n):
        size = rng.randrange(1, 7)
        chats[i] = [(("user", "assistant")[t % 2], rng.choice(["a", "b", ODD[t % len(ODD)]])) for t in range(size)]
    return chats


def table(spark, chats, more=()):
    rows = [(c, t, r, x) for c, turns in chats.items() for t, (r, x) in enumerate(turns)]
    return spark.createDataFrame([*rows, *more], "conv_id bigint, turn bigint, role string, text string")


@pytest.mark.parametrize("files", [(None, None), FILES])
def test_digests_are_those_of_the_input(spark, files):
    chats = random_chats(1)
    frame = table(spark, chats).repartition(5).selectExpr("*", "1 AS depth", "'x' AS path")
    got = chat_tree.digests(chat_tree.format_chats(frame, *files)).collect()
    assert {r.conv_id: tuple(r)[1:] for r in got} == {c: plain_digest(t) for c, t in chats.items()}
    assert len(got) == len(chats)


def test_a_wrong_interval_changes_the_digest(spark):
    """The digests come from the intervals: without one, or with one too many, they are others."""
    chats = {1: [("user", "q"), ("assistant", "a"), ("user", "r")], 2: [("user", "q"), ("user", "other")]}
    forest = chat_tree.format_chats(table(spark, chats))

    def digest(attends):
        nodes = forest.nodes.withColumn("attends", F.expr(attends))
        got = chat_tree.digests(dataclasses.replace(forest, nodes=nodes)).collect()
        return {r.conv_id: tuple(r)[1:] for r in got}

    right = {c: plain_digest(t) for c, t in chats.items()}
    assert digest("attends") == right
    nothing = digest("slice(attends, 1, 0)")
    assert nothing == {1: plain_digest(chats[1][2:]), 2: plain_digest(chats[2][1:])}
    # The whole sequence before the node: right where no sibling stands before it.
    whole = digest("IF(start > 0, array(named_struct('start', 0L, 'end', start)), attends)")
    assert whole != right and sum(whole[c] == right[c] for c in chats) == 1


@pytest.mark.parametrize("stretch", [1, 7, 10_000])
def test_intervals_find_their_nodes_whatever_the_stretch(spark, monkeypatch, stretch):
    monkeypatch.setattr(chat_tree, "STRETCH", stretch)
    chats = random_chats(5)
    got = chat_tree.digests(chat_tree.format_chats(table(spark, chats))).collect()
    assert {r.conv_id: tuple(r)[1:] for r in got} == {c: plain_digest(t) for c, t in chats.items()}


def test_forest(spark):
    chats = random_chats(2)
    forest = chat_tree.format_chats(table(spark, chats))
    nodes = forest.nodes.collect()
    prefixes = {tuple(turns[: i + 1]) for turns in chats.values() for i in range(len(turns))}
    assert len(nodes) == len(prefixes) == len({n.node_id for n in nodes})
    by_id, trees = {n.node_id: n for n in nodes}, {}
    for node in nodes:
        trees.setdefault(node.tree_id, []).append(node)
        assert node.length == len(node.ids)
    assert len(trees) == len({turns[0] for turns in chats.values()})
    for own in trees.values():
        # Gapless, and depth-first: the parent of each node is on the path to the node before it.
        end, path = 0, []
        for node in sorted(own, key=lambda n: n.start):
            assert node.start == end
            end += node.length
            while path and path[-1].node_id != node.parent_id:
                path.pop()
            assert (node.parent_id is None) == (not path) and node.depth == len(path)
            assert node.position == sum(a.length for a in path)
            seen = {i for a in path for i in range(a.start, a.start + a.length)}
            assert {i for s in node.attends for i in range(s.start, s.end)} == seen
            # Intervals that meet are one.
            assert all(a.end < b.start for a, b in zip(node.attends, node.attends[1:]))
            path.append(node)
    # What the last turn attends to, and itself, is the conversation.
    leaf_of = {m.conv_id: m.leaf_id for m in forest.members.collect()}
    for conv_id, turns in chats.items():
        leaf = by_id[leaf_of[conv_id]]
        tokens = {n.start + i: c for n in trees[leaf.tree_id] for i, c in enumerate(n.ids)}
        places = [i for s in leaf.attends for i in range(s.start, s.end)] + list(range(leaf.start, leaf.start + leaf.length))
        assert chat_tree.read_turns("".join(chr(tokens[i]) for i in places)) == turns


def test_loss_mask_covers_assistant_bodies(spark):
    forest = chat_tree.format_chats(table(spark, {1: [("user", "q"), ("assistant", MARKED), ("Assistant", "x")]}), *FILES)
    codec = chat_tree.Codec(*forest.codec)
    masked = [chat_tree.unescaped(codec.decode(n.ids[n.loss_start : n.loss_end])) for n in forest.nodes.orderBy("depth").collect()]
    assert masked == ["", MARKED, ""]


def test_nulls_ties_and_repeated_rows(spark):
    more = [
        (None, 0, "user", "x"), (None, 1, None, None), (7, None, "user", "first"), (7, 0, "user", "then"), (7, 0, "user", "then"),
        (8, 0, "b", "tie"), (8, 0, "a", "tie"), (9, 0, None, ""), (10, 0, "", None),
    ]
    got = {r.conv_id: tuple(r)[1:] for r in chat_tree.digests(chat_tree.format_chats(table(spark, {}, more), *FILES)).collect()}
    assert got[None] == plain_digest([("user", "x"), ("", "")])
    assert got[7] == plain_digest([("user", "first"), ("user", "then"), ("user", "then")])
    assert got[8] in (plain_digest([("b", "tie"), ("a", "tie")]), plain_digest([("a", "tie"), ("b", "tie")]))
    assert got[9] == got[10] == plain_digest([("", "")])


def test_empty_and_long(spark):
    assert chat_tree.digests(chat_tree.format_chats(table(spark, {}), *FILES)).count() == 0
    chats = {1: [("user" if t % 2 else "assistant", f"turn {t}") for t in range(500)], 2: [("user", "long " * 100_000)]}
    got = chat_tree.digests(chat_tree.format_chats(table(spark, chats), *FILES)).collect()
    assert {r.conv_id: tuple(r)[1:] for r in got} == {c: plain_digest(t) for c, t in chats.items()}


def test_conversations_of_very_many_turns_are_never_held_together(spark, monkeypatch):
    """No value that is written grows with a conversation, and its turns lie in many tasks."""
    longest, parts = {}, {}

    def spied(rows, purpose):
        made = common.frozen(rows, purpose)
        texts = [F.max(F.length(name)) for name, kind in made.dtypes if kind == "string"]
        longest[purpose] = max((v or 0 for v in made.agg(*texts).first()), default=0) if texts else 0
        parts[purpose] = made.select(F.input_file_name()).distinct().count()
        return made

    monkeypatch.setattr(chat_tree, "frozen", spied)
    turn = lambda n, kind="t": ("assistant" if n % 2 else "user", f"{kind}{n % 700}")
    whole = [turn(n) for n in range(3000)]
    # Others leave it, end on it, and repeat one of those; one turn is repeated alone.
    chats = {1: whole[:2000] + [turn(n, "b") for n in range(50)], 2: whole[:2500], 4: [turn(1)] * 900}
    chats[3] = chats[1]
    more = [(None, n, r, x) for n, (r, x) in enumerate(whole)]
    forest = chat_tree.format_chats(table(spark, chats, more).repartition(6))
    got = {r.conv_id: tuple(r)[1:] for r in chat_tree.digests(forest).collect()}
    assert got == {c: plain_digest(t) for c, t in [*chats.items(), (None, whole)]}
    assert max(longest.values()) < 1000, longest
    assert parts["chat-prefixes"] > 4
    trees = {}
    for node in forest.nodes.select("tree_id", "start", "length", "position", "attends").collect():
        trees.setdefault(node.tree_id, []).append(node)
        assert node.position == sum(s.end - s.start for s in node.attends) and len(node.attends) <= 2
    assert sorted(map(len, trees.values())) == [900, 3050]
    for own in trees.values():
        own.sort(key=lambda n: n.start)
        assert all(a.start + a.length == b.start for a, b in zip(own, own[1:])) and own[0].start == 0
