"""Spelling variants, the conversation trie and fingerprints against plain loops."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from lakeweir.llm import conversation_trie, fingerprints, spelling

DOCS = "doc_id long, text string, word string, n string, key string, part string"
TALK = "conv_id long, turn long, role string, text string, prefix string, digests string"


def same(got, want):
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def spelled(rows):
    counts = collections.Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 199 == 0 else run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))

    by_word = {w: [v for v in words if near(w, v)] for w in words}
    form = {}
    for word, others in by_word.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        if best and words[best] >= 5 * words[word]:
            form[word] = best
    out = []
    for word, n in words.items():
        root = word
        while root in form:
            root = form[root]
        out.append((word, form.get(word), root, n, len(by_word[word]), words.get(form.get(word))))
    return out


def test_spelling(frame):
    dice = random.Random(5)
    base = ["abcabca", "müssen", "ÀGRAVE", "aaaaaaa", "x" * 60, "lettersin", "Zzzzzz"]
    words = list(base)
    for _ in range(250):
        word = dice.choice(words)
        at = dice.randrange(len(word) + 1)
        words.append(word[:at] + dice.choice(["", "a", "b", "é", "ÿ"]) + word[at + dice.randint(0, 1) :])
    rows = [(dice.choice([None, i, 2**60 + i]), " ".join(dice.choice(words) for _ in range(dice.choice([0, 5, 200])))) for i in range(60)]
    rows += [(7, ", ".join(base * 300)), (8, None), (9, ""), rows[3], rows[3]]
    docs = frame(DOCS, *[(i, t, "x", "y", None, "z") for i, t in rows])
    want = spelled(rows)
    assert any(r[1] != r[2] and r[1] for r in want)
    for largest in (spelling.LARGEST, 30, 2):
        same(spelling.spelling_variants(docs, largest).collect(), want)
    assert spelling.spelling_variants(docs.limit(0)).columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert spelling.spelling_variants(docs.limit(0)).count() == 0


def test_acceptor_is_minimal_and_composes():
    dice = random.Random(3)
    words = sorted({"".join(dice.choice("ab") for _ in range(dice.randint(0, 6))) for _ in range(60)})
    acceptor = spelling.Acceptor(words)
    rests = {}
    for word in words:
        for k in range(len(word) + 1):
            rests.setdefault(frozenset(w[k:] for w in words if w.startswith(word[:k])), set())
    assert len(acceptor.edges) == len(rests)
    pairs = [frozenset(p) for p in spelling.one_edit_pairs(acceptor)]
    assert len(pairs) == len(set(pairs))
    edits = lambda w: {w[:k] + c + w[k + d :] for k in range(len(w) + 1) for c in ("", "a", "b") for d in (0, 1)} - {w}
    assert set(pairs) == {frozenset((a, b)) for a in words for b in words if b in edits(a)}


def test_chain_of_forms(frame):
    links = frame("word string, form string", *[(f"w{k}", f"w{k + 1}") for k in range(21)], ("v", "w20"))
    same(spelling.roots(links).collect(), [(f"w{k}", "w21") for k in range(21)] + [("v", "w21")])


def trie(rows):
    turns = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            said = f"{len(role or '')}:{role or ''}{text or ''}"
            turns[conv].append((turn is not None, turn or 0, hashlib.sha256(said.encode()).hexdigest(), role or "", text or ""))
    own = {c: [t[3:] for t in sorted(v)] for c, v in turns.items()}
    paths = {c: tuple(own.get(c - c % 5, [])[: (h := zlib.crc32(str(c).encode()) % 9)] + v[h:]) for c, v in own.items()}
    members = collections.defaultdict(list)
    for c in sorted(paths):
        for d in range(len(paths[c]) + 1):
            members[paths[c][:d]].append(c)
    children = collections.Counter(k[:-1] for k in members if k)
    leaves, saved = collections.Counter(), collections.Counter()
    for node, convs in members.items():
        for d in range(len(node) + 1):
            saved[node[:d]] += (len(convs) - 1) * (len(node[-1][1].encode()) if node else 0)
            leaves[node[:d]] += not children[node]
    ends = lambda node: ",".join(str(c) for c in members[node] if len(paths[c]) == len(node))
    return [
        (m[0], len(k), members[k[:-1]][0] if k else None, len(m), children[k], leaves[k], saved[k],
         hashlib.sha256(ends(k).encode()).hexdigest())
        for k, m in members.items()
    ]


def test_conversations(frame):
    dice = random.Random(3)
    rows = []
    for conv in [*range(0, 300), 2**60 + 1, 2**60 + 3, 2**60 + 4]:
        if conv % 25 != 10:
            first = dice.choice(["Hello", "Hello", None, "é"])
            for turn in range(dice.choice([1, 2, 3, 12])):
                rows.append((conv, turn, dice.choice(["u", "a", None]) if turn > 2 else "u", first if turn < 3 else dice.choice(["", "x", "yy"])))
    rows += [(None, 0, "u", "lost"), (301, None, None, None), (301, None, "u", "t"), (301, 4, "u", "t"), (301, 4, "u", "t"), (302, 0, "u", "l" * 100_000)]
    rows += [(1000 + k, 0, "system", "the very same") for k in range(5000, 9500)]
    dice.shuffle(rows)
    table = frame(TALK, *[(*r, "p", "d") for r in rows])
    want = trie(rows)
    for largest in (conversation_trie.LARGEST, 40, 1):
        same(conversation_trie.conversation_trie(table, largest).collect(), want)
    assert conversation_trie.conversation_trie(table.limit(0)).count() == 0
    turnless = frame(TALK, (3, 0, "u", "t", None, None))
    assert zlib.crc32(b"3") % 9 > 0
    same(conversation_trie.conversation_trie(turnless).collect(), trie([(3, 0, "u", "t")]))


def test_double_array_holds_every_sequence():
    dice = np.random.default_rng(1)
    lengths = dice.integers(0, 9, 400)
    lengths[7] = 3000
    starts = np.concatenate([[0], np.cumsum(lengths)])
    symbols = dice.zipf(1.5, int(starts[-1])) % 300
    array = conversation_trie.DoubleArray(symbols, starts)
    assert len(array.check) < 4 * len(symbols)
    states = {}
    for level, (active, state) in enumerate(array.walk()):
        for k, s in zip(active, state):
            states.setdefault(int(s), set()).add(hash(tuple(symbols[starts[k] : starts[k] + level + 1].tolist())))
    assert all(len(v) == 1 for v in states.values())
    assert len(states) == len({hash(tuple(symbols[a : a + d].tolist())) for a, n in zip(starts, lengths) for d in range(1, n + 1)})


def plain_sketch(text):
    octets, mask = text.encode(), (1 << 64) - 1
    shingles = {octets[i : i + 16] for i in range(len(octets) - 15)} or ({octets} if octets else set())

    def spread(x):
        x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & mask
        x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & mask
        return x ^ (x >> 31)

    base = 0xD1B54A32D192ED03
    hashes = sorted(
        spread((sum((o + 1) * pow(base, i, 1 << 64) for i, o in enumerate(s)) + len(s) * 0x9E3779B97F4A7C15) & mask) for s in shingles
    )
    return [h for h in hashes if h < (1 << 64) // 32] or hashes[:1]


@pytest.fixture(scope="module")
def texts():
    dice = random.Random(2)
    letters = "abcdé 日\n"
    return ["", "a", "é" * 7, "x" * 15, "y" * 16, *["".join(dice.choice(letters) for _ in range(n)) for n in (40, 300, 3000)] * 2]


@pytest.mark.parametrize("block", [1 << 19, 64])
def test_sketches(texts, block, monkeypatch):
    monkeypatch.setattr(fingerprints, "BLOCK", block)
    assert [s.tolist() for s in fingerprints.sketches(texts)] == [plain_sketch(t) for t in texts]


def test_sketches_merge_and_contain(texts):
    dice = random.Random(4)
    long = "".join(dice.choice("abcdefgh ") for _ in range(200_000))
    part = long[50_000:80_000]
    whole, piece, halves = *fingerprints.sketches([long, part]), fingerprints.sketches([long[:100_015], long[100_000:]])
    assert fingerprints.merge(halves).tolist() == whole.tolist()
    assert fingerprints.containment(piece, whole) == fingerprints.containment(whole, piece) == 1.0
    assert abs(fingerprints.jaccard(piece, whole) - 0.15) < 0.02
    assert fingerprints.from_text(fingerprints.to_text(whole)).tolist() == whole.tolist()
    empty = fingerprints.sketches([""])[0]
    assert fingerprints.containment(empty, empty) == 1.0 and fingerprints.containment(empty, whole) == 0.0


def test_fingerprints(frame, texts):
    dice = random.Random(6)
    rows = [(k * 3, dice.choice(texts)) for k in range(200)]
    rows += [(2**60 + 7, "a" * 90), (2**60 + 3, "b" * 99), (None, None), (None, "no id"), (-5, "minus"), (9, texts[6]), (9, texts[6]), (9, None)]
    dice.shuffle(rows)
    keys = {r: (r[0] is not None, r[0] or 0) for r in rows}
    table = frame(DOCS, *[(i, t, "w", "n", "k", "p") for i, t in rows])
    got = fingerprints.fingerprint_documents(table.repartition(7)).collect()
    assert len(got) == len(rows)
    # Rows of one id come in an order of our own; all others have one next document.
    alone = {i for i, n in collections.Counter(r[0] for r in rows).items() if n == 1}
    order = sorted(rows, key=keys.get)
    by_id = {r.doc_id: r for r in got if r.doc_id in alone}
    for (i, text), (j, after) in zip(order, order[1:] + order[:1]):
        if i in alone and j in alone:
            text, after, row = text or "", after or "", by_id[i]
            edited = text[: len(text) - len(text) // 4] + after[: len(text) // 4]
            mine, other, next_one = (fingerprints.sketches([t])[0] for t in (text, edited, after))
            assert (row.n_chars, row.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
            assert (row.fingerprint, row.edited_fingerprint) == tuple(map(fingerprints.to_text, (mine, other)))
            assert (row.near_edited, row.near_next) == (fingerprints.containment(mine, other), fingerprints.containment(mine, next_one))
    assert fingerprints.fingerprint_documents(table.limit(0)).count() == 0
    one = fingerprints.fingerprint_documents(frame("doc_id long, text string", (4, "alone in here"))).collect()
    assert [(r.doc_id, r.near_next) for r in one] == [(4, 1.0)]
