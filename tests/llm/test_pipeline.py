"""Every stage against brute force on its own input; the whole run against the stages."""

import math
import re
from collections import Counter

import corpus_pipeline
from shopmart.llm import packing, queries
from shopmart.llm.common import read
from tests.llm.conftest import ODD_ROWS, SF_SMALL
from tests.llm.test_pairs import brute_fingerprint, brute_groups
from tests.llm.test_texts import SECRETS, brute_hits, brute_spans, check_bins


def rows_of(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages(spark, docs, tmp_path):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "simhash_near_dedup", "benchmark_decontamination", "secret_scan",
        "best_fit_packing"]
    before, sizes = docs, []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = f"{tmp_path}/{name}"
        stage(spark, before, SF_SMALL).write.parquet(path)
        after = spark.read.parquet(path)
        if name == "best_fit_packing":
            packed = after.collect()
            break
        assert after.columns == docs.columns
        a, b = rows_of(before), rows_of(after)
        assert set(b) <= set(a) and len(b) == after.count()
        sizes.append(len(b))
        if name == "quality_classifier":
            good = {r.doc_id for r in queries.op9_quality_classifier(spark, SF_SMALL).collect()
                    if r.predicted}
            assert set(b) == good
            labels = {r.doc_id: r.quality for r in read(spark, SF_SMALL, "labels").collect()}
            kept = Counter((labels[d], d in b) for d in labels)  # 87 labels teach little
            assert kept[1, True] >= 0.9 * (kept[1, True] + kept[1, False])
        elif name == "simhash_near_dedup":
            fps = {d: brute_fingerprint(r.text) for d, r in a.items()}
            group = brute_groups(set(fps.values()))
            least = {}
            for d, f in fps.items():
                least[group[f]] = min(least.get(group[f], d), d)
            assert set(b) == set(least.values())
        elif name == "benchmark_decontamination":
            items = [(r.item_id, r.text) for r in read(spark, SF_SMALL, "benchmark").collect()]
            hits = brute_hits([r.text for r in a.values()], items, 10)
            assert set(b) == {d for d, (_, n, _) in zip(a, hits) if n == 0}
        else:
            assert set(b) == set(a)
            for d, r in a.items():
                text, done, spans = "", 0, brute_spans(SECRETS, r.text)
                for _, start, stop in spans:
                    if stop > done:
                        text += r.text[done:start] + "[SECRET]" if start >= done else ""
                        done = stop
                assert b[d].n_chars == len(b[d].text)
                assert re.sub(r"\S*\[SECRET\]\S*", "", b[d].text) == \
                    re.sub(r"\S*\[SECRET\]\S*", "", text + r.text[done:])
        if name != "secret_scan":
            assert all(a[d] == b[d] for d in b)
        before = after
    check_bins(packed, packing.CAPACITIES)
    largest = max(packing.CAPACITIES)
    assert Counter(r.doc_id for r in packed) == Counter(
        {d: math.ceil((len(r.text.encode()) + 1) / largest) for d, r in rows_of(before).items()})
    assert sizes[0] > sizes[1] > sizes[2] == sizes[3]
    whole = corpus_pipeline.run(spark, SF_SMALL)
    assert Counter((r.doc_id, r.piece, r.length) for r in whole.collect()) == Counter(
        (r.doc_id, r.piece, r.length) for r in packed)


def test_stages_on_odd_rows(spark, odd, empty):
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, odd, SF_SMALL)
        got = out.collect()
        if name != "best_fit_packing":
            assert out.columns == odd.columns
            assert not Counter(r.doc_id for r in got) - Counter(d for d, _ in ODD_ROWS)
        assert stage(spark, empty, SF_SMALL).count() == 0
