import hashlib
import re
import time
from itertools import combinations

import numpy as np
import pytest

from wordmill.llm import pii

# The patterns as stated.
PATTERNS = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(d := re.sub("[^0-9]", "", m)) <= 19 and luhn(d)),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(re.sub("[^0-9]", "", m)) <= 15),
}


def luhn(digits):
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(digits[::-1])]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def brute(text):
    return [(k, m.start(), m.end()) for k, (p, ok) in PATTERNS.items() for m in re.finditer(p, text or "") if ok(m[0])]


ODD = [
    None, "", "a@b.c", "x.y%+-_@d-e.f.g. z", "a@b.c@d.e f@g", "@a.b c@.d e@f", "a@b.c_d@e.f", "1.2.3.4.5.6.7.8.9", "256.1.1.1 255.255.255.0001",
    "99999.1.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1112 4111111111111111", "4111 1111 1111 1111 1111 1111", "12 34",
    "+1 (911) 555-1477", "+1 ( 2", "++12345678 +1", "é +49.30.1234567 é", "+1234567890123456", "1" * 20_000, "a" * 20_000 + "@", "@" * 500 + "a@b.c",
    "٣٤٥٦٧٨٩٠ +٣٤٥٦٧٨٩٠١", "1.2.3.４",
]


def rows_of(df):
    return sorted((str(r.doc_id), r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in df.collect())


def wanted(rows):
    out = []
    for key, text in rows:
        base = brute(text)
        digest = hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in base).encode()).hexdigest()
        out.append((str(key), *[sum(b[0] == k for b in base) for k in PATTERNS], digest))
    return sorted(out)


def test_base_spans_of_all_rows(frame, spark):
    rows = list(enumerate(ODD)) + [(None, "a@b.c"), (2, "a@b.c")]
    assert rows_of(pii.scan_digest(frame(rows, spans="x"), None)) == wanted(rows)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    field = pii.train(docs)
    got = pii.scan_digest(docs, field)
    assert rows_of(got) == wanted([(r.doc_id, r.text) for r in docs.collect()])
    assert pii.scan_digest(frame([]), field).count() == 0
    assert pii.train(frame([])) is None and pii.train(frame([(1, "no numbers"), (2, None)])) is None


@pytest.fixture(scope="module")
def field(spark):
    return pii.train(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_spans_that_the_field_adds(field):
    added = lambda t: pii.added_spans(t, pii.base_spans(t), field)
    assert ("phone", 5, 19) in added("call (911) 555-1477 now")
    for date in (
        "2024-11-12 12", "12.05.1980 14", "01.05.1980 14", "2019-2020 2021", "100-200 300-400", "101 202 303 404",
        "2024-11-12 12:30:15", "2024-11-12T12:30:15.123456", "1990 1991 1992", "10 20 30 40 50 60",
    ):
        assert added(f"so {date} it is") == [], date
    for clean in ("on 2016-01-02 at 12:30", "version 1.2.3", "pages 12 to 345", "4111 1111 1111 1112", "", "in 1999 and 2003", "300.400.1.2"):
        assert added(clean) == [], clean
    for text in ("a@b.example.com", "+1 (911) 555-1477", "4111 1111 1111 1111", "10.0.0.1"):
        assert added(text) == []


def test_held_out_decoding_agrees_with_the_patterns(spark, field):
    """On texts that the fit has not seen, the field by itself finds what the patterns find."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").filter("doc_id % 3 = 1 and text rlike '[0-9@]'")
    hit = missed = extra = 0
    for r in docs.limit(600).collect():
        base = set(pii.base_spans(r.text))
        found = set()
        for a, b in pii.zones(r.text):
            zone = pii.read_zone(r.text, a, b)
            found |= {(pii.KINDS[k], zone.edges[i], zone.edges[j]) for i, j, k in field.decode(zone)}
        hit, missed, extra = hit + len(base & found), missed + len(base - found), extra + len(found - base)
    assert hit > 100 and missed / (hit + missed) < 0.05 and extra / (hit + extra) < 0.05


def segmentations(zone, kinds):
    spans = [(i, j, k) for i, j, f in zone.candidates for k in range(kinds) if pii.admissible(f)[k]]
    for size in range(4):
        for chosen in combinations(spans, size):
            ordered = sorted(chosen)
            if all(a[1] <= b[0] for a, b in zip(ordered, ordered[1:])):
                yield ordered


def test_dynamic_programming_against_all_segmentations():
    rng = np.random.default_rng(0)
    kinds = len(pii.KINDS)
    for text in ("a@b.cc 1.2.3.4", "+1234567890 9@x.yy"):
        zone = pii.read_zone(text, 0, len(text))
        zone = pii.Zone(zone.edges, [zone.candidates[i] for i in rng.permutation(len(zone.candidates))[:5]])
        f = pii.SpanField(rng.normal(size=(len(pii.FEATURES), kinds)), rng.normal(size=(kinds + 1, kinds)))
        feature = {(i, j): x for i, j, x in zone.candidates}

        def score(spans, g=f, feature=feature):
            states = [kinds, *(k for _, _, k in spans)]
            return sum(feature[i, j] @ g.span[:, k] + g.after[s, k] for (i, j, k), s in zip(spans, states))

        every = list(segmentations(zone, kinds))
        assert max(len(s) for s in every) < 4
        assert f.decode(zone) == max(every, key=score)
        truth = every[len(every) // 2]
        value, span, after = f.gradient(zone, truth)
        assert value == pytest.approx(score(truth) - np.logaddexp.reduce([score(s) for s in every]))
        step, moved = 1e-6, f.span.copy()
        moved[0, 1] += step
        assert (pii.SpanField(moved, f.after).gradient(zone, truth)[0] - value) / step == pytest.approx(span[0, 1], abs=1e-3)
        moved = f.after.copy()
        moved[kinds, 2] += step
        assert (pii.SpanField(f.span, moved).gradient(zone, truth)[0] - value) / step == pytest.approx(after[kinds, 2], abs=1e-3)


def test_many_spans_in_a_text_take_time_in_proportion(field):
    for blank in (" ", " and "):
        text = blank.join(f"a{i}@example.com" for i in range(16_000))
        start = time.process_time()
        base = pii.base_spans(text)
        assert len(base) == 16_000 and pii.added_spans(text, base, field) == []
        assert time.process_time() - start < 8


def test_the_sample_ranks_hashes_and_takes_equal_rows_once(frame, monkeypatch):
    seen = []
    monkeypatch.setattr(pii, "fit_field", lambda texts: seen.append(texts))
    rows = [(1, "a@b.c")] * 50 + [(i, f"number {i}") for i in range(2, 40)]
    for sample in (5, 100):
        pii.train(frame(rows), sample)
    assert [len(t) for t in seen] == [5, 39] and set(seen[0]) <= set(seen[1])
