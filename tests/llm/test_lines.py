import random
import re
from collections import Counter

from intake.llm.lines import Rules, figures, ruled
from tests.llm.conftest import by_id

SPLIT = re.compile(r"[\x20\x09-\x0D]+")


def slow(rows, rules=Rules()):
    """Verdicts of (doc_id, text, lang, source) rows, by loops."""
    host_documents, line_documents = {}, {}
    for row, (i, text, _, source) in enumerate(rows):
        document = ("row", row) if i is None else i
        host_documents.setdefault(source, set()).add(document)
        for line in (text or "").split("\n"):
            words = [w for w in SPLIT.split(line) if w]
            if words:
                plain = "".join(c.lower() if "A" <= c <= "Z" else c for c in " ".join(words))
                line_documents.setdefault((source, plain), set()).add(document)
    limit = {
        s: min(rules.line_ceiling, max(rules.line_floor, rules.line_share * len(d))) for s, d in host_documents.items()
    }
    out = {}
    for i, text, _, source in rows:
        text = text or ""
        words = [w for w in SPLIT.split(text) if w]
        windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
        count = Counter(windows)
        again = {k + d for k, w in enumerate(windows) if count[w] > 1 for d in range(3)}
        full = [line for line in text.split("\n") if SPLIT.sub("", line)]
        removed = 0
        for line in full:
            own = [w for w in SPLIT.split(line) if w]
            plain = "".join(c.lower() if "A" <= c <= "Z" else c for c in " ".join(own))
            removed += len(own) * (len(line_documents[source, plain]) > limit[source])
        failed = len(words) < 50 or 100 * len(again) > 50 * len(words)
        left = len(words) - removed >= rules.least_left * len(words)
        out[i] = (
            len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(full) - len(set(full)), len(again),
            failed, removed, not failed and left,
        )
    return out


COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "removed_words", "kept")


def test_odd_texts(documents):
    texts = [
        None, "", " \n\n\t", "a b c a b c a b c d", "x", "x y", "x y z x y z", "a\n a\na \n a\n\n", "é # | <> &amp; " * 30,
        "same line\nsame line\n" * 60, "w " * 40000, " ".join(f"w{i % 700}" for i in range(5000)), "A\x85B\xa0c\x1cd e\x0bf\x0cg",
        "\U0001f600 \U0001f600\U0001f600 #" * 20, "a" * 200000, "\n" * 1000 + "end",
    ]
    rows = [(i, t, "en", None if i % 3 == 0 else "s") for i, t in enumerate(texts)]
    got = by_id(ruled(documents(*rows, extra=True)), *COLUMNS)
    want = slow(rows)
    for i in want:
        assert got[i] == want[i], (i, got[i], want[i])


def test_shared_lines_count_documents_of_a_host(documents):
    rng = random.Random(5)
    fresh = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    rows = []
    for i in range(150):  # a hot host, with a footer that 40 of its documents share
        text = fresh(60) + ("\nAll  Rights Reserved" if i < 40 else "")
        rows.append((i, text, "en", "hot"))
    menu = fresh(70)
    rows += [(200 + i, menu + "\n" + fresh(5 if i % 2 else 90), "en", "hot") for i in range(30)]
    rows += [(300 + i, menu + "\n" + fresh(5), "en", "cold") for i in range(10)]
    copy = fresh(80)
    rows += [(400 + i, copy, "en", "hot") for i in range(60)]  # copies are documents, each on its own
    got = by_id(ruled(documents(*rows)), *COLUMNS)
    want = slow(rows)
    assert got == want
    assert want[0][-2] == 3 and want[0][-1]
    assert not want[201][-1] and want[200][-1] and want[300][-1] and not want[400][-1]


def test_limits_of_small_and_large_hosts(documents):
    rng = random.Random(6)
    fresh = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    menu, footer = fresh(60), fresh(4)
    rows = [(i, menu, "en", "copies") for i in range(1000)]
    rows += [(2000 + i, menu + "\n" + fresh(60), "en", "small") for i in range(20)]
    # 2 % of a large host would be 120: what 101 of its documents share goes, what 100 share stays.
    for i in range(6000):
        shared = (i < 101) * f"\n{footer}" + (i < 100) * "\nwe use cookies"
        rows.append((10000 + i, fresh(50) + shared, "en", "large"))
    got = by_id(ruled(documents(*rows)), *COLUMNS)
    assert not any(got[i][-1] for i in range(1000))
    assert all(got[2000 + i][-2:] == (60, True) for i in range(20))
    assert [got[10000 + i][-2] for i in (0, 99, 100, 101)] == [4, 4, 4, 0]


def test_rows_that_repeat_and_no_rows(documents):
    text = " ".join(f"w{i}" for i in range(60))
    got = ruled(documents((1, text), (1, text), (None, text))).collect()
    assert [(r.doc_id, r.n_words, r.kept) for r in sorted(got, key=lambda r: r.doc_id or 0)] == [(None, 60, True), (1, 60, True), (1, 60, True)]
    assert ruled(documents()).collect() == []
    got = ruled(documents(*[(None, text)] * 11, *[(1, text)] * 11)).collect()  # 12 documents
    assert len(got) == 22 and not any(r.kept for r in got)
    assert all(r.kept for r in ruled(documents(*[(None, text)] * 9, *[(1, text)] * 11)).collect())


def test_no_python_in_the_plan(documents, plan):
    docs = documents((1, "a b c"))
    for df in (figures(docs), ruled(docs)):
        assert not re.search("EvalPython|MapIn|FlatMap|CoGroup|Pandas|Arrow", plan(df))
