"""Replies that quote whole passages, lines, sentences and re-wrapped parts of the given turns, against a plain version."""

from __future__ import annotations

import random
import re
import textwrap

from indicatorlake.llm import quotes

CHAT = "conv_id long, turn long, role string, text string"


def passages(lines):
    """Whole run, lines and sentences, in small letters with single blanks."""
    clean = [" ".join(x.split()).lower() for x in lines]
    whole = " ".join(x for x in clean if x)
    return {whole, *clean, *re.split(r"(?<=[.!?…。！？]) ", whole)} - {""}


def runs(text, depth):
    """Lists of neighbouring lines of one quote level."""
    out, current = [], []
    for line in text.split("\n"):
        level = 0
        while re.match(r"[ \t]*>", line):
            line, level = re.sub(r"^[ \t]*>", "", line, count=1), level + 1
        if level == depth and line.strip():
            current.append(line)
        else:
            out, current = out + [current], []
    return [r for r in [*out, current] if r]


def plain_parents(chat):
    """The parent of every turn of one conversation, by going through all earlier turns for every quoted passage."""
    own = {turn: {p for run in runs(text, 0) for p in passages(run)} for turn, text in chat}
    parents = {}
    for turn, text in chat:
        votes = {}
        for level in range(1, 20):
            for p in {p for run in runs(text, level) for p in passages(run)}:
                source = min((t for t, said in own.items() if p in said), default=None)
                if source is not None and source < turn:
                    best, size = votes.get(source, (level, 0))
                    votes[source] = (min(best, level), size + len(p))
        parents[turn] = max(votes, key=lambda s: (-votes[s][0], votes[s][1], s), default=None)
    return parents


def quoting(rng, said):
    """A reply to an earlier text: it quotes all of it, a line, a sentence, or some sentences wrapped anew."""
    lines = [x for x in said.split("\n") if x.strip()]
    if not lines:
        return "nothing to quote"
    line = rng.choice(lines)
    sentences = re.split(r"(?<=[.!?]) ", " ".join(line.split()))
    at = rng.randrange(len(sentences))
    part = rng.choice([said, line, sentences[at], " ".join(sentences[at : at + rng.randrange(1, 4)])])
    wrapped = textwrap.wrap(part, rng.choice([30, 70, 1000])) if rng.random() < 0.6 else part.split("\n")
    deeper = [f"> > {x}" for x in textwrap.wrap(lines[0], 40)] if rng.random() < 0.2 else []
    return "\n".join([*deeper, *(f"> {x}" for x in wrapped), "", f"My answer number {rng.randrange(10**6)}."])


def test_replies_find_what_they_quote(spark):
    rng = random.Random(6)
    given = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").orderBy("conv_id", "turn").collect()
    chats = {}
    for r in given:
        if r.conv_id is not None and r.turn is not None and r.conv_id < 60:
            chats.setdefault(r.conv_id, {}).setdefault(r.turn, r.text or "")
    rows = []
    for conv, turns in chats.items():
        said = sorted(turns.items())
        for k in range(5):
            said.append((1000 + k, quoting(rng, rng.choice(said)[1])))
        rows += [(conv, turn, "user", text) for turn, text in said]
        turns.update(said)
    found = {(r.conv_id, r.turn): r.parent_turn for r in quotes.reply_order(spark.createDataFrame(rows, CHAT)).collect()}
    expected = {(conv, turn): parent for conv, turns in chats.items() for turn, parent in plain_parents(sorted(turns.items())).items()}
    assert found == expected
    replies = [p for (_, turn), p in found.items() if turn >= 1000]
    assert sum(p is not None for p in replies) > 0.8 * len(replies) > 100


def test_one_sentence_and_rewrapped_lines_of_a_paragraph(spark):
    chat = [(1, 0, "user", "First things first. How do I sort a very long list of names?  It has to be fast. Thanks!"),
            (1, 1, "assistant", "Use sorted(). It is stable.\nIt takes a key as well."),
            (1, 2, "user", "> How do I sort a very\n> long list of names?\n\nFound it."), (1, 3, "user", "> It is stable. It takes\n> a key as well.\n\nGood."),
            (1, 4, "user", "> It is\n\nNo sentence.")]
    found = {r.turn: r.parent_turn for r in quotes.reply_order(spark.createDataFrame(chat, CHAT)).collect()}
    assert found == {0: None, 1: None, 2: 0, 3: 1, 4: None}
