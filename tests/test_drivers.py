import random

import pytest

from weftmatch.plans import drivers as D
from weftmatch.sources import tables


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    r = random.Random(4)
    top = tmp_path_factory.mktemp("data")
    (top / "train").mkdir()
    words = "alpha beta gamma delta omega sigma kappa zeta theta lambda rho tau phi chi psi".split()
    files = {1: [], 2: [], 3: []}
    truth = []
    for i in range(1, 61):
        name = f"{r.choice(words)} {r.choice(words)} works{i}"
        addr = f"{i} {r.choice(words)} road, town{i}"
        files[1].append((f"S1-{i}", f"{name} limited", addr, "X"))
        listed = []
        if i % 3:
            files[2].append((f"S2-{i}", f"{name} ltd", addr.replace("road", "rd"), "X"))
            listed.append(f"S2-{i}")
        files[3].append((f"S3-{i}", f"{r.choice(words)} other{i}", f"{900 + i} elsewhere{i}", "X"))
        truth.append((f"S1-{i}", ",".join(listed)))
    for k, rows in files.items():
        (top / "train" / f"source{k}.tsv").write_text("\t".join(tables.SOURCE_COLUMNS) + "\n" + "".join("\t".join(x) + "\n" for x in rows))
    (top / "train" / "ground_truth.tsv").write_text("\t".join(tables.TRUTH_COLUMNS) + "\n" + "".join("\t".join(x) + "\n" for x in truth))
    return str(top)


def test_baseline_and_inference(spark, root, tmp_path):
    sources = tables.load_all_sources(spark, root, "train")
    truth = tables.truth_pairs(tables.load_ground_truth(spark, root))
    got = D.run_baseline(sources, truth, k=5, max_df=1.0, min_count=5)
    assert got["evaluation"]["f05"] > 0.9 and got["candidates"]["recall"] == 1.0
    normalizer = D.learn_normalizer(D.prenormalized(sources), truth, 5)
    assert {(r["token"], r["canon"]) for r in normalizer["addr"].collect()} == {("rd", "road")}
    assert {(r["token"], r["canon"]) for r in normalizer["name"].collect()} == {("ltd", "limited")}
    D.save_normalizer(normalizer, f"file://{tmp_path}/n")
    stats = D.run_inference(sources, D.load_normalizer(spark, f"file://{tmp_path}/n"), got["rule"], str(tmp_path / "out"), 5, 1.0)
    assert stats["errors"] == [] and stats["matching_results_rows"] == 60 and stats["report"][0]["entities"] == 60


def test_profile(spark, root):
    text = D.render(D.profile(tables.load_source(spark, root, "train", 1)))
    assert "## integrity" in text and "| ALL | 60 |" in text


def test_training_and_learned_inference(spark, root, tmp_path):
    sources = tables.load_all_sources(spark, root, "train")
    truth = tables.truth_pairs(tables.load_ground_truth(spark, root))
    one = dict.fromkeys(("fielded", "addr", "name_word", "name_char"), 1.0)
    got = D.run_training(sources, truth, f"file://{tmp_path}/m", 5, max_df=one, kinds=("gbt",), maxIter=3, maxDepth=2)
    assert got["validation"]["f05"] > 0.8 and got["full"]["summary"]["f05"] > 0.8 and got["full"]["candidates"]["recall"] == 1.0
    assert set(got["tuned"]) == {"global", "source", "relative", "abstain", "stage2"}
    stats = D.run_learned_inference(sources, f"file://{tmp_path}/m", f"file://{tmp_path}/out")
    assert stats["errors"] == [] and stats["matching_results_rows"] == 60 and stats["matching_results_pairs"] >= 30
    D.main(["validate", root, "train", f"file://{tmp_path}/out"])


def test_profile_of_labels(spark, root):
    rec = D.prenormalized(tables.load_all_sources(spark, root, "train")).withColumnRenamed("name_pre", "name_norm").withColumnRenamed("addr_pre", "addr_norm")
    truth = tables.truth_pairs(tables.load_ground_truth(spark, root))
    found = D.profile_truth(truth, rec)
    assert {r["matches"]: r["n"] for r in found["cardinalities"].collect()} == {0: 20, 1: 40}
    assert found["source_mix"].first()["only_s2"] == 40
    rows = {r["kind"]: r for r in D.pair_agreement(truth, rec).collect()}
    assert rows["true"]["pairs"] == rows["random"]["pairs"] == 40 and rows["true"]["name_jaccard"] > rows["random"]["name_jaccard"] + 0.3 and rows["true"]["number_shared"] == 1.0
