"""Alignment of two tokenizers against a plain version, token by token."""

import hashlib
from collections import Counter, defaultdict

import pytest
import sentencepiece
from tokenizers import Tokenizer

from residualkit.llm import alignment
from residualkit.llm.frames import table

SCHEMA = "doc_id long, text string, row long, a string, same int"
FILES = alignment.public_files()


class Plain:
    """Each document by itself, from the two libraries and dictionaries alone."""

    def __init__(self):
        self.a = Tokenizer.from_file(FILES.byte_tokenizer)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=FILES.piece_model)
        printing = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.letter = {chr(b): b for b in printing} | {
            chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in printing)
        }

    def bytes_a(self, i):
        return bytes(self.letter[c] for c in self.a.id_to_token(i))

    def bytes_b(self, i):
        return bytes([i - 3]) if self.b.is_byte(i) else self.b.id_to_piece(i).replace("▁", " ").encode()

    def ranges(self, ids, spell):
        out, at = [], 0
        for i in ids:
            out.append((i, at, at + len(spell(i))))
            at = out[-1][2]
        return out

    def document(self, text):
        if not text:
            return [], [], [], []
        a, b = self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)
        raw = (" " + text).encode()
        if b"".join(map(self.bytes_a, a)) != raw or b"".join(map(self.bytes_b, b)) != raw:
            return [], [], [], []
        a, b = self.ranges(a, self.bytes_a), self.ranges(b, self.bytes_b)
        links, j = [], 0
        for i, s, e in a:
            while j and b[j][1] > s:
                j -= 1
            while b[j][2] <= s:
                j += 1
            k = j
            while k < len(b) and b[k][1] < e:
                links.append((i, b[k][0]))
                k += 1
        groups, own = [], ([], [])
        both = {e for _, _, e in a} & {e for _, _, e in b}
        for cut in sorted(both):
            own = [[i for i, _, e in side if (groups[-1][0] if groups else 0) < e <= cut] for side in (a, b)] if len(raw) < 3000 else None
            groups.append((cut, own))
        return [i for i, _, _ in a], [i for i, _, _ in b], groups, links


def brute(texts):
    plain = Plain()
    found = [plain.document(t) for t in texts]
    counts = Counter(pair for *_, links in found for pair in set(links))
    best = defaultdict(int)
    for (a, _), n in counts.items():
        best[a] = max(best[a], n)
    rows = []
    for a, b, groups, links in found:
        spelled = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for _, (x, y) in groups) if not groups or groups[0][1] else None
        digest = (hashlib.sha256(spelled.encode()).hexdigest() if spelled else "") if spelled is not None else None
        rows.append((len(a), len(b), len(groups), len(links), sum(counts[p] == best[p[0]] for p in links), sum(counts[p] for p in links), digest))
    return rows


TEXTS = [
    None,
    "",
    " ",
    "a",
    "The quick brown fox, and the quick brown dog.",
    "the the the aaaa aaa aa a",
    "naïve café — 北京 ☃ 🙂 é",
    "a▁b is not spelled",
    "<|endoftext|> <s> </s> <unk> <0x41> are plain",
    "tab\tnew\nline\r\n  two  blanks  ",
    "x\x00y\x7f",
    "The quick brown fox, and the quick brown dog.",
    "word " * 300,
    "é" * 40 + "🙂" * 9,
]


def answers(spark, texts, **options):
    df = spark.createDataFrame([(i, t, 7, "x", 1) for i, t in enumerate(texts)], SCHEMA)
    rows = sorted(alignment.alignment(df, **options).collect(), key=lambda r: r.doc_id)
    return [tuple(r[c] for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")) for r in rows]


@pytest.mark.parametrize("pairs_at_most", [alignment.PAIRS_AT_MOST, 0])
def test_equals_plain_version(spark, pairs_at_most):
    assert answers(spark, TEXTS, pairs_at_most=pairs_at_most) == brute(TEXTS)


def test_documents_of_the_table_equal_plain_version(spark):
    texts = [r.text for r in table(spark, "/root/testdata/sf0.001", "documents").select("text").orderBy("doc_id").collect()]
    got, want = answers(spark, texts), brute(texts)
    assert len(got) == len(want)
    assert all(g[:6] == w[:6] and w[6] in (None, g[6]) for g, w in zip(got, want, strict=True))


def test_groups_are_kept_on_request(spark):
    df = spark.createDataFrame([(1, "naïve café")], "doc_id long, text string")
    row = alignment.alignment(df, spell=True).first()
    assert hashlib.sha256(row.groups.encode()).hexdigest() == row.groups_sha256
    a, b = zip(*[g.split("|") for g in row.groups.split(";")], strict=True)
    plain = Plain().document("naïve café")
    assert [int(i) for g in a for i in g.split(",")] == plain[0]
    assert [int(i) for g in b for i in g.split(",")] == plain[1]


def test_very_long_texts_repeated_ids_and_no_rows(spark):
    blanks, letters = " " * 400_000, "ab" * 300_000
    df = spark.createDataFrame([(1, blanks), (1, letters), (None, letters)], "doc_id long, text string")
    rows = alignment.alignment(df).collect()
    assert sorted((r.doc_id is None, r.n_a > 0, r.n_groups > 0) for r in rows) == [(False, True, True)] * 2 + [(True, True, True)]
    assert len({r.groups_sha256 for r in rows}) == 2
    assert alignment.alignment(df.limit(0)).count() == 0


def test_fast_and_full_encoders_agree(spark):
    own = alignment.tokenizers(FILES)
    for r in table(spark, "/root/testdata/sf0.001", "documents").select("text").collect():
        text = " " + (r.text or "")
        assert own.encode_a(text).tolist() == own.full.encode(text, add_special_tokens=False).ids
