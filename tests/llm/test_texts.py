"""Personal data, quality rules, LM scoring, chat formatting and WARC against brute force."""
import hashlib
import html.parser
import math
import random
import re
import time
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stayflow.llm import chat_format, hashing, lm_scoring, personal_data, quality_rules, warc

# ---------------------------------------------------------------- personal data

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(match):
    digits = [int(c) for c in match if c.isdigit()]
    total = sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(reversed(digits)))
    return 13 <= len(digits) <= 19 and total % 10 == 0


KEEP = {"email": lambda m: True, "ip": lambda m: all(int(x) <= 255 for x in m.split(".")), "card": luhn,
        "phone": lambda m: 9 <= sum(c.isdigit() for c in m) <= 15}


def base_spans(text):
    return [f"{k}:{m.start()}:{m.end()}" for k in BASE
            for m in re.finditer(BASE[k], text or "") if KEEP[k](m.group())]


def test_base_spans(docs_of):
    rng = random.Random(5)
    letters = list("ab1234567890.@+-() %_é😀") + ["1.2.3.4", "4111 1111 1111 1111", "a@b.co", "+1 (743) 555-3824", " "]
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 60))) for _ in range(1500)]
    texts += [None, "", "1" * 20000, "a" * 50000, "a.b" * 9000 + "@x" + ".y" * 9000, "1 " * 9000,
              "+" + "1 " * 9000, "256.1.1.1.1", "0000255.0.0.1", "x@y", "x@y.z@w.v"]
    found = personal_data.digest_columns(personal_data.personal_data(docs_of(list(enumerate(texts))))).collect()
    assert len(found) == len(texts)
    for r in found:
        want = base_spans(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert r.spans.split(",")[:len(want)] == (want or r.spans.split(",")[:0])
        counts = Counter(w.split(":")[0] for w in want)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(counts[k] for k in BASE)


def wilson(k, n, z=1.0):
    p = k / n
    return (p + z * z / (2 * n) - z * math.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)


def telling(rows, window, low):
    """Brute force of the method: every place of a term that tells an entity."""
    n, holds = len(rows), defaultdict(set)
    docs_e, near, spans = defaultdict(set), defaultdict(set), []
    for row, text in enumerate(rows):
        text = text or ""
        spans.append([(k, m.start(), m.end()) for k in BASE for m in re.finditer(BASE[k], text)
                      if KEEP[k](m.group())])
        mails = [(a, b) for k, a, b in spans[row] if k == "email"]
        runs = [(m.start(), m.end()) for m in re.finditer(r"[^\W\d_]+", re.sub(
            BASE["email"], lambda m: "0" * len(m.group()), text))]
        assert not any(a < y and x < b for a, b in runs for x, y in mails)
        for a, b in runs:
            if b - a >= 3:
                holds[text[a:b].lower()].add((row, a, b))
        for k, a, b in spans[row]:
            docs_e[k, text[a:b]].add(row)
            for x, y in runs:
                if y - x >= 3 and (a - window <= x and y <= a or b <= x and y <= b + window):
                    near[text[x:y].lower(), (k, text[a:b])].add(row)
    out = set()
    for term, places in holds.items():
        docs_t = {row for row, _, _ in places}
        for entity, docs in docs_e.items():
            d = len(docs & docs_t)
            d = d if d >= 3 else len(near[term, entity])
            if not d or len(docs) == n:
                continue
            share = wilson(d, len(docs_t))
            if share >= .5 - 1e-12 and math.log(n * share / len(docs)) / math.log(n / len(docs)) > low:
                out |= places
    return out


def test_telling_terms_and_sanitised_text(docs_of):
    rng = random.Random(8)
    common = [f"{a}{b}" for a in ("alpha", "beta", "gamma", "delta") for b in ("one", "two", "zen")]
    rows = []
    for i in range(300):
        words = rng.choices(common, k=30)
        if i % 10 == 0:  # the same person, always named beside the address
            words[10:10] = ["Zaphod", "Beeblebrox", "zb@galaxy.example.org", "president"]
            words.append("Fjords")
        if i % 15 == 0:
            words[3:3] = ["host", "10.0.0.7"]
        rows.append(" ".join(words))
    rows += ["zaphod alone", None, ""]
    docs = docs_of(list(enumerate(rows)))
    found = personal_data.personal_data(docs, keep=docs.columns)
    got = found.select("doc_id", "terms", "text", personal_data.sanitise(found).alias("clean")).collect()
    spans = {(r.doc_id, t.start, t.end) for r in got for t in r.terms}
    want = telling(rows, personal_data.WINDOW, personal_data.GENERALISE)
    assert spans == want and any("Beeblebrox" == rows[d][a:b] for d, a, b in spans)
    assert (300, 0, 6) in spans  # zaphod, in a text without the address
    assert sum("Fjords" == rows[d][a:b] for d, a, b in spans) == 30  # far from the address
    assert not any(rows[d][a:b] in common for d, a, b in spans)
    for r in got:
        if not base_spans(r.text):
            assert r.clean == r.text.replace("zaphod", "")
        else:
            assert not base_spans(r.clean) and "Beeblebrox" not in r.clean
    assert personal_data.personal_data(docs.limit(0)).count() == 0


def test_entities_of_one_or_two_documents_have_telling_terms(docs_of):
    rng = random.Random(3)
    common = [f"{a}{b}" for a in ("alpha", "beta", "gamma", "delta") for b in ("one", "two", "zen")]
    rows = [" ".join(rng.choices(common, k=30)) for _ in range(300)]
    rows[7] += " Trillian once@galaxy.example.org " + rows[8]
    for i in (20, 21):
        rows[i] += " Slartibartfast twice@magrathea.example.org " + rows[9]
    for i in range(40, 60):  # a word of many documents, once beside an entity
        rows[i] += " Vogon"
    rows[40] += " poet@vogsphere.example.org"
    found = personal_data.personal_data(docs_of(list(enumerate(rows)))).collect()
    told = sorted((r.doc_id, rows[r.doc_id][t.start:t.end]) for r in found for t in r.terms)
    assert told == [(7, "Trillian"), (20, "Slartibartfast"), (21, "Slartibartfast")]


# ---------------------------------------------------------------- quality rules

def rules(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    inside = {i + k for i in range(len(words) - 4) if windows[tuple(words[i:i + 5])] > 1 for k in range(5)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""),
            len(lines) - len(set(lines)), len(inside))


def test_quality_counts_and_bands(docs_of, sample):
    texts = [None, "", "a b c d e f a b c d e f", "x\n\nx\n x\n\nx", "\xa0a\x1cb é #*$", "w " * 4000,
             "q" * 9000, "😀 " * 20, "many different words stand here in one plain line of text"]
    rows = [(i, t, None if i % 2 else "en") for i, t in enumerate(texts, 10 ** 6)] + sample
    found = quality_rules.quality_rules(docs_of(rows)).collect()
    assert len(found) == len(rows)
    text_of = {i: t for i, t, _ in rows}
    for r in found:
        want = rules(text_of[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (r.base_failed and r.kept)
    assert quality_rules.quality_rules(docs_of(rows).limit(0)).count() == 0


def kneser_ney(texts):
    """Modified Kneser-Ney trigrams of characters, by their definition."""
    m = quality_rules.MARK
    tri = Counter(k for t in texts for s in [m + m + t] for k in zip(s, s[1:], s[2:]))
    bi = Counter((b, c) for _, b, c in tri)
    uni = Counter(c for _, c in bi)

    def level(counts):
        n = [sum(v == k for v in counts.values()) for k in (1, 2, 3, 4)]
        if all(n):
            y = n[0] / (n[0] + 2 * n[1])
            d = [min(max(k - (k + 1) * y * n[k] / n[k - 1], .05), k - .05) for k in (1, 2, 3)]
        else:
            d = [.5, 1., 1.5]
        total, left = Counter(), Counter()
        for k, v in counts.items():
            total[k[:-1]] += v
            left[k[:-1]] += round(d[min(v, 3) - 1] * quality_rules.UNIT)
        own = {k: (v - d[min(v, 3) - 1]) / total[k[:-1]] for k, v in counts.items()}
        return own, {k: left[k] / quality_rules.UNIT / total[k] for k in total}

    o1, l1 = level({(c,): v for c, v in uni.items()})
    o2, l2 = level(bi)
    o3, l3 = level(tri)
    p1 = {c: v + l1[()] / (len(uni) + 1) for c, v in o1.items()}
    p2 = {k: v + l2[k[:1]] * p1[k[1:]] for k, v in o2.items()}
    p3 = {k: v + l3[k[:2]] * p2[k[1:]] for k, v in o3.items()}
    return p1, p2, p3, l2, l3


def test_model_is_modified_kneser_ney(docs_of, sample):
    texts = [t[:300] for _, t, _ in sample[:40]]
    model = quality_rules.fit(docs_of([(i, t, "en") for i, t in enumerate(texts)]).select("lang", "text"))
    p1, p2, p3, l2, l3 = kneser_ney(texts)
    assert len(p3) - 3 <= len(model.arrays[3][0]) <= len(p3) and (model.arrays[3][0][1:] > model.arrays[3][0][:-1]).all()
    new = "the Qz#w and"

    def prob(a, b, c):
        if (a, b, c) in p3:
            return p3[a, b, c]
        back = l3.get((a, b), 1.0)
        if (b, c) in p2:
            return back * p2[b, c]
        return back * l2.get((b,), 1.0) * p1.get((c,), 2 ** (-model.unknown / quality_rules.UNIT))

    for text in [*texts[:10], new]:
        codes = quality_rules._codes([text])
        cost = model.costs("en", codes)[:len(text)]
        s = quality_rules.MARK * 2 + text
        want = [-math.log2(prob(*k)) * quality_rules.UNIT for k in zip(s, s[1:], s[2:])]
        assert max(abs(a - b) for a, b in zip(cost, want)) <= 4


def test_bands_part_prose_from_noise(docs_of, sample):
    rng = random.Random(2)
    noise = [(10 ** 6 + i, " ".join("".join(rng.choices("qxzjkw{}[]~^0189", k=7)) for _ in range(900)), "en")
             for i in range(4)]
    found = {r.doc_id: r for r in quality_rules.quality_rules(docs_of(sample + noise)).collect()}
    assert not any(found[i].kept for i, _, _ in noise)
    good = [r for r in found.values() if r.doc_id < 10 ** 6 and not r.base_failed]
    assert sum(r.kept for r in good) >= 0.97 * len(good)


def test_copies_do_not_close_a_band(docs_of, sample):
    small = [r for r in sample if r[2] == "es"]
    text = max((r[1] for r in small if not quality_rules.base_counts(r[1])[4]), key=len)
    copies = [(10 ** 6 + i, text, "es") for i in range((len(sample) + 1) // 2)]  # a third of all
    few, many = ({r.doc_id: r for r in quality_rules.quality_rules(docs_of(rows)).collect()}
                 for rows in (sample, sample + copies))
    assert len(copies) > 3 * len(small) and len(many) == len(sample) + len(copies)
    for i, _, _ in sample:
        assert (few[i].bits_per_char, few[i].low, few[i].high, few[i].kept) == (
            many[i].bits_per_char, many[i].low, many[i].high, many[i].kept)
    assert {many[i].kept for i, _, _ in copies} == {True}


# ---------------------------------------------------------------- LM scoring

@pytest.mark.parametrize("frequent, hot", [(lm_scoring.FREQUENT, lm_scoring.HOT), (300, 20), (0, 1)])
def test_cross_entropy_difference(spark, docs_of, sample, frequent, hot):
    rows = [(i, t) for i, t, _ in sample[:120]] + [(10 ** 6, None), (10 ** 6 + 1, "ZZ  zz")]
    rows += [(10 ** 7 + i, f"only{i} once{i} here{i % 2}") for i in range(20)]
    targets = {i for i, _ in rows[::3]}
    labels = spark.createDataFrame([(i,) for i in targets] * 2 + [(None,)], "doc_id long")
    found = {r.doc_id: r for r in lm_scoring.cross_entropy_difference(
        docs_of(rows), labels, frequent=frequent, hot=hot).collect()}
    assert len(found) == len(rows)
    for i, n, target, back in cross_entropy(rows, targets):
        assert found[i].n_tokens == n
        assert found[i].target_bits == pytest.approx(target, abs=1e-9)
        assert found[i].background_bits == pytest.approx(back, abs=1e-9)
        assert found[i].difference == pytest.approx(target - back, abs=1e-9)


def cross_entropy(rows, targets):
    docs = [(i, (t or "").encode().lower().split()) for i, t in rows]
    different = {w for _, ws in docs for w in ws}
    chains = [(i, ["<s>", *ws, "</s>"]) for i, ws in docs]

    def count(only):
        pairs, words = Counter(), Counter()
        for i, s in chains:
            if only(i):
                pairs.update(zip(s, s[1:]))
                words.update(s)
        return pairs, words

    models = [count(lambda i: i in targets), count(lambda i: True)]
    for i, s in chains:
        bits = []
        for (pairs, words), own in zip(models, (i in targets, True)):
            total, all_words = 0, sum(words.values()) - words["<s>"]
            for (v, w), k in Counter(zip(s, s[1:])).items():
                p = lm_scoring.A * (pairs[v, w] - k * own) / words[v] if words[v] else 0
                p += (1 - lm_scoring.A) * ((1 - lm_scoring.B) * words[w] / max(1, all_words)
                                           + lm_scoring.B / (len(different) + 1))
                total += k * round(-math.log2(p) * lm_scoring.UNIT)
            bits.append(total / lm_scoring.UNIT / (len(s) - 1))
        yield i, len(s) - 1, *bits


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aAbB\u00e9 \t\n\x0b\x1c\u2003\U0001f600", max_size=12), max_size=6),
       st.integers(1, 200))
def test_hashes_of_texts_tell_their_words(texts, size):
    texts = [*texts, "x" * size, "X" * size + " y" + "x" * size]
    hashes, lengths = hashing.hashes_of(texts)
    found = [w for t in texts for w in t.encode().lower().split()]
    assert lengths.tolist() == [len(t.encode().split()) for t in texts] and len(hashes) == len(found)
    assert len(set(zip(found, hashes.tolist()))) == len(set(found)) == len(set(hashes.tolist()))


def test_hashes_of_many_words():
    found = [f"{a}{b}" for a in range(700) for b in "abcdefghijklmnopqrstuvwxyz"] + ["z" * 65 + str(i) for i in range(999)]
    one, lengths = hashing.hashes_of([" ".join(found)] * 20)
    assert lengths.tolist() == [len(found)] * 20 and len(set(one.tolist())) == len(set(found))


def test_lm_scoring_without_documents_or_targets(spark, docs_of):
    docs, none = docs_of([(1, "a b"), (1, "a b"), (None, "c")]), spark.createDataFrame([], "doc_id long")
    assert lm_scoring.cross_entropy_difference(docs.limit(0), none).count() == 0
    rows = lm_scoring.cross_entropy_difference(docs, none).collect()
    assert sorted((str(r.doc_id), r.n_tokens) for r in rows) == [("1", 3), ("1", 3), ("None", 2)]


 
# ---------------------------------------------------------------- chat formatting

def test_snapshots_collapse(spark):
    rows = [(c, t, "user", x) for c, text in ((1, "ab"), (2, "abc"), (3, "abc"), (4, "b"), (5, "ax")) for t, x in enumerate(text)]
    rows += [(None, 0, "user", "a"), (6, 0, None, None), (6, 0, None, None), (7, None, "user", "q"), (7, 5, "user", "r")]
    rows += [(8, i, "user", f"t{i}") for i in range(1300)] + [(9, i + 3, "user", f"t{i}") for i in range(700)]
    rng = random.Random(1)
    logs = {100 + i: [rng.choice("ab") for _ in range(rng.randint(1, 5))] for i in range(60)}
    rows += [(c, t, "user", f"log {x}") for c, xs in logs.items() for t, x in enumerate(xs)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn(
        "block", F.lit("clash")).withColumn("place", F.lit(0)).repartition(4)
    parts = defaultdict(list)
    for r in chat_format.chat_format(df).collect():
        parts[r.conv_id].append(r)
    cut = defaultdict(list)  # the same conversations in smaller pieces
    for r in chat_format.chat_format(df, most=2).collect():
        cut[r.conv_id].append(r)
    turns = defaultdict(set)
    for c, t, role, x in rows:
        if c is not None:
            turns[c].add((-1 if t is None else t, role or "unknown", x or ""))
    chains = {c: [x[1:] for x in sorted(s)] for c, s in turns.items()}
    want = {c for c, s in chains.items() if not any(
        d != c and s == o[:len(s)] and (len(o) > len(s) or d < c) for d, o in chains.items())}
    assert set(parts) == want
    for c, some in parts.items():
        text, small = ("".join(r.rendered for r in sorted(x, key=lambda r: r.turns_before))
                       for x in (some, cut.pop(c)))
        assert small == text and [r.part for r in sorted(some, key=lambda r: r.turns_before)] == sorted(
            r.part for r in some)
        assert text == "".join(f"<|im_start|>{r}\n{x}<|im_end|>\n" for r, x in chains[c])
        assert {(r.n_turns, r.n_copies) for r in some} == {
            (len(chains[c]), sum(o == chains[c] for o in chains.values()))}
        assert sum(r.part_turns for r in some) == len(chains[c]) and max(r.part_turns for r in some) <= chat_format.BLOCK
    assert not cut
    assert chat_format.chat_format(df.limit(0)).count() == 0


def test_many_texts_under_one_turn_number(spark):
    rows = [(c, t, "user", f"text {i}") for c, t in ((1, None), (2, None), (3, 7)) for i in range(9000)]
    rows += [(2, 0, "user", "more"), (2, 0, "user", "more"), (3, 8, "user", "next")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = defaultdict(list)
    for r in chat_format.chat_format(df).collect():
        found[r.conv_id].append(r)
    # texts under one number are ordered by hash, so 1 is a prefix of 2 and of 3
    assert set(found) == {2, 3}
    for c, last in ((2, "more"), (3, "next")):
        parts = sorted(found[c], key=lambda r: r.turns_before)
        assert [r.turns_before for r in parts] == [sum(r.part_turns for r in parts[:k]) for k in range(len(parts))]
        assert max(r.part_turns for r in parts) < 2 * chat_format.BLOCK and parts[0].n_turns == 9001
        lines = "".join(r.rendered for r in parts).split("<|im_end|>\n")[:-1]
        assert lines[-1].endswith(last) and len(lines) == 9001
        assert set(lines[:-1]) == {f"<|im_start|>user\ntext {i}" for i in range(9000)}


def test_chat_formatting_runs_no_python(spark):
    df = spark.createDataFrame([(1, 0, "user", "a")], "conv_id long, turn long, role string, text string")
    plan = chat_format.chat_format(df)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


# ---------------------------------------------------------------- WARC

class Text(html.parser.HTMLParser):
    def __init__(self):
        super().__init__()
        self.parts, self.hidden = [], 0

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in ("script", "style", "template", "noscript")

    def handle_endtag(self, tag):
        self.hidden -= tag in ("script", "style", "template", "noscript")

    def handle_data(self, data):
        if not self.hidden:
            self.parts.append(data)


def test_warc_derivatives(spark, tmp_path):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("page_id", "url", "html")
    odd = [(10 ** 6, None, None), (10 ** 6 + 1, "http://x/\r\nWARC-Evil: 1", "<p>a<br>b &amp; c<!-- x --><script>1<2</script>\n\n d 3 < 4"),
           (10 ** 6 + 2, "u", "é" * 100000), (10 ** 6 + 3, "u", "<style>open"), (None, "u", "<title>T &lt;x</title>")]
    pages = pages.union(spark.createDataFrame(odd, pages.schema)).withColumn("type", F.lit(1)).withColumn("block", F.lit(1))
    source = {r.record_id: r for r in warc.responses(pages).collect()}
    rows = warc.derivatives(warc.responses(pages)).collect()
    assert len(rows) == 2 * pages.count() and len({r.record_id for r in rows}) == len(rows)
    by_id = {r.record_id: r for r in rows}
    for r in rows:
        own = source[r.refers_to]
        assert (r.page_id, r.target_uri, r.source_digest, r.date) == (own.page_id, own.target_uri, own.payload_digest, own.date)
        assert r.source_headers == own.http_headers and by_id[r.concurrent_to].concurrent_to == r.record_id
        assert r.content_length == len(r.block.encode()) and r.block_digest == warc.digest(r.block.encode())
        assert f"WARC-Refers-To: {r.refers_to}\r\n" in r.header and "WARC-Evil: 1\r\n" not in r.header.replace("/ WARC-Evil: 1", "")
        if r.type == "conversion":
            parser = Text()
            parser.feed(own.payload)
            parser.close()
            if "<style>open" not in own.payload:
                assert "".join("".join(parser.parts).split()) == "".join(r.block.split())
        else:
            assert f"source-payload-digest: {own.payload_digest}\r\n" in r.block
            assert "source-content-type: text/html; charset=utf-8\r\n" in r.block
    path = str(tmp_path / "out.warc")
    warc.write_warc(spark.createDataFrame(rows).repartition(3), path)
    back = warc.read_warc(spark, path).collect()
    assert sorted((r.header, bytes(r.block)) for r in back) == sorted((r.header, r.block.encode()) for r in rows)
    assert warc.derivatives(warc.responses(pages.limit(0))).count() == 0


def test_page_text_keeps_lines():
    assert warc.page_text("<h1>A</h1><p>b <b>c</b>\t d</p>\n<ul><li>e</li></ul>") == "A\nb c d\ne"


def test_large_losses_are_divided_among_shares():
    import numpy as np

    docs = np.array([1, 2, 9], np.uint32)
    sums = [np.array([5, 7, 10 ** 6]), np.array([0, 2 ** 33 + 3, 11]), np.array([2 ** 31, 1, 2 ** 40 + 1])]
    out = lm_scoring._divided(docs, *sums)
    assert all(x.dtype == np.uint32 for x in out)
    for s, x in zip(sums, out[1:]):
        assert [int(x[out[0] == d].astype(np.int64).sum()) for d in docs] == s.tolist()


def test_telling_terms_of_random_texts(docs_of):
    rng = random.Random(12)
    mails = [f"m{i}@x.example.org" for i in range(6)] + [f"10.0.0.{i}" for i in range(6)]
    names = ["Arthur", "FORD", "Marvin", "Éowyn", "Ünal", "ab", "zoë"] + [f"w{c}{c}w" for c in "abcdefgh"]
    common = ["alpha", "beta", "gamma", "delta", "omega", "sigma"]
    rows = []
    for i in range(150):
        words = rng.choices(common, k=rng.randrange(1, 25))
        for k in rng.sample(range(12), rng.choice([0, 0, 1, 1, 2, 5])):
            at = rng.randrange(len(words) + 1)
            words[at:at] = rng.sample([mails[k], names[k]], 2) + [names[k + 3]] * (rng.random() < .5)
        if rng.random() < .05:
            words.append(rng.choice(names))
        if rng.random() < .2:
            words.insert(0, f"unique{chr(97 + i % 26)}{chr(97 + i // 26)}")
        rows.append(rng.choice([" ", ", ", "\n"]).join(words))
    for window in (60, 12):
        found = personal_data.personal_data(docs_of(list(enumerate(rows))), window=window).collect()
        got = {(r.doc_id, t.start, t.end) for r in found for t in r.terms}
        assert got == telling(rows, window, personal_data.GENERALISE) and len(got) > 10


def test_a_hundred_thousand_spans_in_one_text(docs_of):
    many = " ".join(f"host 10.{i % 250}.{i // 250 % 250}.{i // 62500} up" for i in range(100_000))
    docs = docs_of([(1, many), (2, "some quiet words"), (3, "host up and about"), (4, "host up again")])
    start = time.monotonic()
    found = personal_data.digest_columns(personal_data.personal_data(docs)).collect()
    want = hashlib.sha256(",".join(base_spans(many)).encode()).hexdigest()
    assert {r.doc_id: (r.n_ip, r.base_sha256) for r in found}[1] == (100_000, want)
    clean = {r.doc_id: r.text for r in personal_data.sanitised(docs).collect()}
    assert clean[1] == re.sub(BASE["ip"], "[IP]", many) and clean[3] == "host up and about"
    assert time.monotonic() - start < 120


def test_many_spans_in_one_text_and_the_sanitised_table(spark, docs_of):
    """The rewritten table equals the rewritten spans, and thousands of spans in a text fit."""
    many = " ".join(f"host 10.{i % 250}.{i // 250}.7 up" for i in range(5000))
    rows = [(1, many), (2, "mail a@b.org now"), (2, "mail a@b.org now"), (3, None), (4, "")]
    rows += [(10 + i, f"contact zaphod at z{i % 3}@x.example.org, friend") for i in range(20)]
    docs = docs_of(rows)
    found = personal_data.personal_data(docs, keep=docs.columns)
    want = sorted(map(str, ((r.doc_id, r.clean) for r in found.select(
        "doc_id", F.when(F.col("kept.text").isNotNull(), personal_data.sanitise(found)).alias("clean")).collect())))
    table = personal_data.sanitised(docs)
    assert table.columns == docs.columns
    got = table.collect()
    assert sorted(map(str, ((r.doc_id, r.text) for r in got))) == want
    assert {r.kept for r in got} == {"clash"} and sum("10." in (r.text or "") for r in got) == 0


def test_pages_are_read_once_from_left_to_right():
    hidden = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|template|noscript)\b[^>]*>.*?(?:</\1\s*>|\Z)", re.S | re.I)
    title = re.compile(r"<title\b[^>]*>(.*?)</title\s*>", re.S | re.I)
    link = re.compile(r"<a\b[^>]*?\bhref\s*=", re.I)
    rng = random.Random(3)
    parts = ["<a ", "<a", " href=", "HREF =", "x", ">", "<title>", "<TITLE x", "</title >", "</title", "<!--", "-->",
             "<script", "<script>", "</script>", "</SCRIPT ", "<style>", "</style>", " ", "<p>", "<", "-", "&#65;"]
    for _ in range(20000):
        page = "".join(rng.choices(parts, k=rng.randrange(12)))
        assert warc._visible(page) == hidden.sub(" ", page), page
        assert warc.count_links(page) == len(link.findall(page)), page
        found = title.search(page)
        want = " ".join(warc.html_lib.unescape(warc._TAG.sub("", found[1])).split()) if found else ""
        assert warc.page_title(page) == want, page


def test_hostile_pages_take_no_longer_than_others():
    start = time.monotonic()
    for part in ("<a ", "<a", "<title>", "<title", "<script", "<script>", "<!--", "</script ", "<p ", "<", "&#", "&"):
        page = part * (1_000_000 // len(part))
        warc.derive(1, "s", "u", warc.DATE, "HTTP/1.1 200 OK\r\n", page, "sha1:x")
    assert time.monotonic() - start < 60
    assert warc.page_text("a&#" + "0" * 5000 + "65;b") == "aAb" and warc.page_text("&#" + "9" * 5000 + ";") == "�"


def test_a_record_without_length_is_an_error():
    with pytest.raises(ValueError, match="f.warc.*no Content-Length"):
        list(warc._records("f.warc", pa.py_buffer(b"WARC/1.1\r\nWARC-Type: x\r\n\r\nbody\r\n\r\n")))
