import hashlib
from collections import Counter

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfcast.llm import chat_tree
from shelfcast.llm.queries import QUERIES

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "conv_id long, turn long, role string, text string, node string"
PIECES = st.lists(st.sampled_from(["<", "|", "\\", "<|im_end|>", "<|im_start|>", "\n", "n", "a", "é", "<\\|", "user"]), max_size=9).map("".join)


@settings(max_examples=500, deadline=None)
@given(st.lists(st.tuples(PIECES, PIECES), max_size=4))
def test_template_is_reversible(turns):
    assert chat_tree.parse("".join(chat_tree.render(r, t) for r, t in turns)) == turns


def rows():
    out = []
    for c in range(40):  # a hot first turn, shared second turns, then own ways
        out += [(c, 0, "system", "be kind"), (c, 1, "user", f"question {c % 4}"), (c, 2, "assistant", f"answer {c % 8} <|im_end|>")]
        out += [(c, 3 + i, "user" if i % 2 == 0 else "assistant", f"more {c} {i}") for i in range(c % 5)]
    out += [(100, 5, "assistant", None), (100, 2, None, "x"), (100, 2, None, "x"), (101, None, "user", ""), (None, 1, "user", "nobody"),
            (102, 0, "a\nb\\", "y"), (103, 0, "system", "be kind")]
    return out + [(104, i, "user" if i % 2 else "assistant", f"t{i} " * 50) for i in range(60)]


def conversations(spark):
    return spark.createDataFrame([(*r, "n") for r in rows()], SCHEMA)


def expected():
    by = {}
    for c, turn, role, text in rows():
        by.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [(r, t) for _, _, r, t in sorted(turns)] for c, turns in by.items()}


def test_conversations_read_back(spark):
    got = chat_tree.read_back(*chat_tree.prefix_tree(conversations(spark), VOCABULARY), VOCABULARY).collect()
    want = expected()
    assert len(got) == len(want)
    for r in got:
        turns = want[r.conv_id]
        loss = "".join(t for role, t in turns if role == "assistant")
        assert r.n_turns == len(turns) and r.loss_chars == len(loss)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        assert r.formatted_chars == sum(len(chat_tree.render(a, b)) for a, b in turns)


def test_tree_is_emitted_once_depth_first(spark):
    tree, paths = chat_tree.prefix_tree(conversations(spark), VOCABULARY)
    nodes = {r.node: r for r in tree.collect()}
    prefixes = {tuple(t[:k + 1]) for t in expected().values() for k in range(len(t))}
    assert len(nodes) == len(prefixes)
    order = sorted(nodes.values(), key=lambda r: r.stream_start)
    at, open_ = 0, []
    for r in order:
        assert r.stream_start == at and len(r.token_ids) == r.n_tokens
        at += r.n_tokens
        while open_ and open_[-1] != r.parent:
            open_.pop()
        assert open_ or r.parent == ""  # depth first: the parent's subtree is still open
        open_.append(r.node)
    for r in order:
        ancestors, up = [], r.parent
        while up:
            ancestors.append(nodes[up])
            up = nodes[up].parent
        assert r.position == sum(a.n_tokens for a in ancestors)
        covered = sorted(x for a, b in r.attends for x in range(a, b))
        assert covered == sorted(x for a in ancestors for x in range(a.stream_start, a.stream_start + a.n_tokens))
        assert all(a[1] < b[0] for a, b in zip(r.attends, r.attends[1:]))  # merged
    depths = Counter(r.conv_id for r in paths.collect())
    assert depths == Counter({c: len(t) for c, t in expected().items()})


def test_query_adds_the_breaking_conversation(spark):
    got = {r.conv_id: r for r in QUERIES["op3_chat_tree"](spark, "/root/testdata/sf0.001").collect()}
    text = "<|im_end|><|im_start|>assistant ok"
    assert got[-1].n_turns == 2 and got[-1].loss_chars == len(text)
    assert got[-1].loss_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert got[-1].turns_sha256 == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()


def test_no_conversations(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert chat_tree.read_back(*chat_tree.prefix_tree(empty, VOCABULARY), VOCABULARY).count() == 0


def test_long_conversations_pass_row_by_row(spark, monkeypatch):
    """No step gathers a conversation: not in a list, and not in one Arrow batch."""
    def refuse(*_):
        raise AssertionError("a conversation is gathered")
    monkeypatch.setattr(chat_tree.F, "collect_list", refuse)
    said = [(None if i % 3 else 7, i, "assistant" if i % 2 else "user", f"t{i} é") for i in range(600)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = chat_tree.read_back(*chat_tree.prefix_tree(spark.createDataFrame([(*r, "n") for r in said], SCHEMA), VOCABULARY), VOCABULARY).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(r.n_turns for r in got) == [200, 400]
    for r in got:
        turns = [(a, b) for c, _, a, b in said if c == r.conv_id]
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256("".join(b for a, b in turns if a == "assistant").encode()).hexdigest()
        assert r.formatted_chars == sum(len(chat_tree.render(a, b)) for a, b in turns)


def test_damage_to_the_stream_is_noticed(spark):
    tree, paths = chat_tree.prefix_tree(conversations(spark), VOCABULARY)
    deep = tree.where("depth = 2").first().node
    here = F.col("node") == deep
    damaged = {
        "an interval": tree.withColumn("attends", F.when(here, F.expr("transform(attends, (a, i) -> CASE WHEN i = 0 THEN array(a[0], a[1] - 1) ELSE a END)"))
                                       .otherwise(F.col("attends"))),
        "a position": tree.withColumn("position", F.when(here, F.col("position") + 1).otherwise(F.col("position"))),
        "a control token": tree.withColumn("token_ids", F.when(here, F.slice("token_ids", F.lit(2), F.size("token_ids"))).otherwise(F.col("token_ids")))}
    for what, broken in damaged.items():
        with pytest.raises(Exception, match="ValueError"):
            chat_tree.read_back(broken, paths, VOCABULARY).collect()
    # other tokens give another text, and so another digest
    other = tree.withColumn("token_ids", F.when(here, F.concat(F.slice("token_ids", F.lit(1), F.size("token_ids") - 1), F.array(F.lit(65), F.element_at("token_ids", -1))))
                            .otherwise(F.col("token_ids")))
    want = {r.conv_id: r for r in chat_tree.read_back(tree, paths, VOCABULARY).collect()}
    changed = [r.conv_id for r in chat_tree.read_back(other, paths, VOCABULARY).collect() if r.turns_sha256 != want[r.conv_id].turns_sha256]
    assert sorted(changed) == sorted({r.conv_id for r in paths.where(F.col("node") == deep).collect()})


def test_loss_mask_covers_the_text_alone(spark):
    from tokenizers import Tokenizer
    decode = Tokenizer.from_file(VOCABULARY).decode
    said = [(1, 0, "assistant", "\n\nstarts and ends with lines\n\n"), (1, 1, "user", "x"), (1, 2, "assistant", " "), (1, 3, "assistant", "é<|im_end|>")]
    tree, _ = chat_tree.prefix_tree(spark.createDataFrame([(*r, "n") for r in said], SCHEMA), VOCABULARY)
    masked = {r.depth: decode(r.token_ids[r.text_start:-1], skip_special_tokens=False) for r in tree.where("loss").collect()}
    assert {d: chat_tree.unescape(t) for d, t in masked.items()} == {c: t for _, c, r, t in said if r == "assistant"}


def test_turns_are_never_broadcast(spark, monkeypatch, capsys):
    plans, store = {}, chat_tree.stored

    def watched(df, name):
        df.explain()
        plans[name] = capsys.readouterr().out
        return store(df, name)

    monkeypatch.setattr(chat_tree, "stored", watched)
    chat_tree.read_back(*chat_tree.prefix_tree(conversations(spark), VOCABULARY), VOCABULARY).explain()
    plans["read"] = capsys.readouterr().out
    assert "BroadcastHashJoin" not in plans["paths"]
    assert "SortMergeJoin" in plans["read"] and "BroadcastHashJoin [conv_no" not in plans["tree"]
