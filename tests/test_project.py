"""Profiles, a project's run over its folder, and the command line."""

import gzip
import json
import math

import pytest
import yaml

from pyspark.sql import functions as F

from weft import uris
from weft.__main__ import main
from weft.functions import langid
from weft.operators.licensing import LicenseError
from weft.plans import profiles as P
from weft.plans.project import Run
from weft.sources import planned, registry
from tests.test_core import GOOD


def project_file(tmp_path, license_="CC-BY-4.0", **more):
    corpus = tmp_path / "in"
    corpus.mkdir(exist_ok=True)
    junk = "#$%& " * 60
    for i, text in enumerate([GOOD[0], GOOD[1].replace("river", "tower").replace("market", "bridge"), GOOD[0], junk]):
        if not (corpus / f"{i}.txt").exists():  # a file written again is a changed one
            (corpus / f"{i}.txt").write_text(text)
    pairs = [{"inputs": "hello", "targets": "good day"}, {"inputs": "Hello ", "targets": "again"}, {"inputs": "x", "targets": "no " * 7}]
    (tmp_path / "pairs.jsonl").write_text("\n".join(map(json.dumps, pairs)))
    langs = tmp_path / "configs" / "languages"
    langs.mkdir(parents=True, exist_ok=True)
    spoken = {"display_name": "Made", "iso639_3": "mde", "scripts": ["Latin"], "sources": [{"connector": "local", "params": {"path": str(corpus), "license": license_}}, {"connector": "nowhere"}]}
    (langs / "made.yaml").write_text(yaml.safe_dump(spoken))
    data = yaml.safe_load(P.scaffold("made")) | {"workdir": str(tmp_path / "work"), "ingest": {"sources": ["local", "nowhere"]}, "convdata": {"native_sets": [{"repo": str(tmp_path / "pairs.jsonl")}], "review": False}} | more
    (tmp_path / "p.yaml").write_text(yaml.safe_dump(data))
    return P.load_project(tmp_path / "p.yaml")


@pytest.fixture
def here(tmp_path, monkeypatch):
    monkeypatch.setenv("WEFT_CONFIG_PATH", str(tmp_path / "configs"))
    return tmp_path


def test_profiles(here):
    assert len(P.slugs("language")) >= 30 and len(P.slugs("model")) == 21
    for slug in P.slugs("language"):
        spoken = P.language(slug)
        assert spoken.default_script in spoken.scripts and (spoken.nllb_code is None or "_" in spoken.nllb_code)
        assert [s.connector for s in spoken.sources].count("fineweb2") == 1
    assert P.language("pashto").sources[-1].params["fineweb"] == "pbt_Arab"
    assert P.language("kurmanji").code == "kmr_Latn" and P.language("sorani").code == "ckb_Arab"
    with pytest.raises(P.ProfileNotFound):
        P.language("nope")


def test_bad_projects_are_refused(here):
    for wrong in ({"stages": ["nope"]}, {"extra": 1}, {"clean": {"min_quality": 2}}, {"clean": {"dedup": "maybe"}}, {"convdata": {"provider": "a_paid_one"}}):
        with pytest.raises(P.ConfigError):
            project_file(here, **wrong)
    assert project_file(here, stages=["export", "ingest", "clean"]).selected == ["ingest", "clean", "export"]


def test_a_project_runs_and_resumes(spark, here):
    project = project_file(here)
    said = Run(spark, project).stages()
    assert set(said.values()) == {"ran"} and list(said)[0] == "ingest"
    card = json.loads((here / "work/artifacts/ingest/ingest_card.json").read_text())
    assert card["mono_docs"] == 4 and "nowhere" in card["skipped"]
    card = json.loads((here / "work/artifacts/clean/data_card.json").read_text())
    assert (card["docs_in"], card["docs_out"], card["duplicate"]) == (4, 2, 1)
    card = json.loads((here / "work/artifacts/convdata/convdata_card.json").read_text())
    assert card == {"generated": 3, "degenerate_dropped": 1, "deduped": 1, "accepted": 1}
    assert "CC-BY-4.0" in (here / "work/artifacts/export/MODEL_CARD.md").read_text()
    assert set(Run(spark, project).stages().values()) == {"skipped"}
    said = Run(spark, project_file(here, clean={"min_quality": 0.6})).stages()
    assert said["ingest"] == "skipped" and said["clean"] == "ran" and said["export"] == "ran"


def test_translated_and_synthetic_pairs(spark, here):
    (here / "seed.jsonl").write_text("\n".join(map(json.dumps, [{"instruction": "say  hi", "response": "hi"}, {"prompt": "and bye", "output": "bye"}, {"instruction": "alone"}])))
    asked = {"translate": [str(here / "seed.jsonl"), "a/hub-set"], "translate_backend": "mock", "synth": {"provider": "mock", "n": 6}, "review": False}
    project = project_file(here, convdata=asked, stages=["ingest", "clean", "convdata"])
    Run(spark, project).stages()
    card = json.loads((here / "work/artifacts/convdata/convdata_card.json").read_text())
    assert (card["generated"], card["accepted"], list(card["skipped"])) == (8, 8, ["translate:a/hub-set"])
    pairs = spark.read.json(str(here / "work/artifacts/convdata/pairs")).orderBy("ord").collect()
    assert [p["instruction"] for p in pairs[:2]] == ["[Made] say hi", "[Made] and bye"] and pairs[0]["source"] == f"translate:{here / 'seed.jsonl'}"
    first = " ".join(GOOD[0].split()[:4])
    assert pairs[2]["instruction"] == f"[Made] Question 1 ({first})?" and pairs[-1]["response"] == "[Made] Answer 6." and pairs[-1]["source"] == "synth"
    said = Run(spark, project_file(here, convdata=asked | {"translate_backend": "nllb", "synth": {"provider": "ollama", "n": 3}}, stages=["convdata"])).stages()
    card = json.loads((here / "work/artifacts/convdata/convdata_card.json").read_text())
    assert said["convdata"] == "ran" and card["generated"] == 0 and set(card["skipped"]) == {f"translate:{here / 'seed.jsonl'}", "translate:a/hub-set", "synth"}


def test_an_open_licence_stops_the_export(spark, here):
    with pytest.raises(LicenseError):
        Run(spark, project_file(here, "unknown", stages=["ingest", "export"])).stages()


def test_command_line(here, capsys, monkeypatch):
    monkeypatch.chdir(here)
    assert main(["init", "welsh"]) == 0 and main(["init", "welsh"]) == 1
    assert P.load_project(here / "projects/welsh.yaml").language == "welsh"
    main(["profiles"])
    main(["sources", "welsh"])
    assert "wikipedia" in capsys.readouterr().out


def test_a_changed_file_is_read_again(spark, here):
    project = project_file(here, stages=["ingest", "clean"])
    assert set(Run(spark, project).stages().values()) == {"ran"}
    assert set(Run(spark, project).stages().values()) == {"skipped"}
    (here / "in" / "9.txt").write_text(GOOD[2])
    assert set(Run(spark, project).stages().values()) == {"ran"}
    card = json.loads((here / "work/artifacts/ingest/ingest_card.json").read_text())
    assert card["mono_docs"] == 5 and card["budget_hit"] is False and card["language"] == "made"


def test_other_languages_are_dropped(spark, here):
    other = "der Fluss querte die alte Stadt und ihren Markt an jedem Morgen des Jahres, und niemand fragte nach dem Weg. "
    rows = [(g, "mde") for g in GOOD] + [(other + str(i), "deu") for i in range(3)]
    model = langid.train(spark.createDataFrame(rows, "text string, lang string"))
    project = project_file(here, stages=["ingest", "clean"])
    (here / "in" / "8.txt").write_text(other * 3)
    Run(spark, project, identifiers={"glotlid": model}).stages()
    card = json.loads((here / "work/artifacts/clean/data_card.json").read_text())
    assert (card["wrong_language"], card["docs_out"], card["language_filter"]) == (2, 2, "on (glotlid)")  # symbols are of no language that it knows


class Echo:
    """A model that likes long options, repeats its prompt's last line and knows one word."""

    def continuations(self, rows):
        return rows.withColumns({"logprob": -1.0 / F.length("continuation"), "n_tokens": F.lit(1).cast("long")})

    def replies(self, rows):
        return rows.withColumn("reply", F.when(F.col("prompt").startswith("Rate"), "I say 4").otherwise(F.concat(F.lit("said "), F.element_at(F.split("prompt", "\n"), -1))))

    def next_words(self, rows):
        return rows.withColumn("predicted", F.lit(" HILLS."))

    def losses(self, blocks):
        return blocks.select(F.lit(2.0).alias("loss"), F.size("tokens").alias("n_tokens"))


def test_benchmarks_and_review_of_outputs(spark, here):
    asked = {"benchmarks": ["native_cloze", "perplexity", "belebele", "global_mmlu", "flores", "judge", "nope"], "limit": 5, "human_review": True, "human_review_n": 1}
    configs = spark.createDataFrame([("belebele", "mde_Latn", False), ("flores", "mde_Latn", True)], "benchmark string, code string, gated boolean")
    items = spark.createDataFrame([(i, "p", "q", 1 + (i == 0), "short", "the longest one", "b", "c") for i in range(4)], "id long, passage string, question string, number int, answer1 string, answer2 string, answer3 string, answer4 string")
    lines = lambda w: spark.createDataFrame([(i, f"{w} {i}") for i in range(4)], "id long, text string")
    project = project_file(here, evaluate=asked, stages=["ingest", "clean", "convdata", "evaluate"])
    go = lambda **k: Run(spark, project, "token", configs=configs, items={"belebele": items, "flores": ((lines("en"), lines("mde")), (lines("English"), lines("English")))}, scorers={"adapted": Echo(), "base": Echo(), "judge": Echo()}, **k).stages(["ingest", "clean", "convdata", "evaluate"], "evaluate")
    go()
    card = json.loads((here / "work/artifacts/evaluate/report_card.json").read_text())
    got, why = card["results"], {b: c["reason"] for b, c in card["coverage"].items()}
    assert why == {"native_cloze": "covered", "perplexity": "covered", "belebele": "covered", "global_mmlu": "no code", "flores": "covered", "judge": "covered", "nope": "unknown benchmark"}
    assert got["belebele"]["adapted"]["value"] == 0.25 and got["belebele"]["delta"] == 0 and got["belebele"]["adapted"]["n"] == 4
    assert got["native_cloze"]["adapted"]["value"] == 0.2 and got["perplexity"]["adapted"]["value"] == pytest.approx(math.exp(2)) and "base" not in got["perplexity"]
    assert got["judge"]["adapted"]["value"] == 4 and 0 < got["flores"]["adapted"]["value"] < 100 and got["flores"]["adapted"]["n"] == 4
    assert card["summary"]["belebele"].startswith("adapted=0.250↑ (95% CI") and card["summary"]["nope"] == "not covered: unknown benchmark"
    assert card["human_review"] == {"total": 1, "reviewed": 0, "pending": 1, "mean_fluency": None, "mean_correctness": None, "status": "awaiting review"}
    queue = here / "work/artifacts/evaluate/human_review_queue.jsonl"
    row = json.loads(queue.read_text())
    assert row["response"] == "said hello" and row["fluency"] is None
    queue.write_text(json.dumps(row | {"status": "reviewed", "fluency": 4, "correctness": 2, "notes": "fine"}))
    go()
    card = json.loads((here / "work/artifacts/evaluate/report_card.json").read_text())
    assert card["human_review"] == {"total": 1, "reviewed": 1, "pending": 0, "mean_fluency": 4.0, "mean_correctness": 2.0}


class Rule:
    """A tokenizer of white-space words with a vocabulary of its own."""

    end = "</s>"

    def __init__(self, known):
        self.known = known

    def tokens(self, text):
        return F.split(text, " ")

    def vocabulary(self, spark):
        return spark.createDataFrame(list(enumerate(self.known)), "id int, token string").select("token", "id")


def test_tokens_are_counted_and_packed(spark, here):
    project = project_file(here, stages=["ingest", "clean", "tokenizer", "pretrain", "convdata", "finetune"], tokenizer={"added_tokens": 2}, pretrain={"max_steps": 1, "seq_len": 64})
    Run(spark, project, tokenizers={"base": Rule(["a", "b"]), "trained": Rule(["c", "a", "d", "e"])}).stages()
    card = lambda stage: json.loads((here / f"work/artifacts/{stage}/{stage}_card.json").read_text())
    assert card("tokenizer") | {"fertility": 0} == {"strategy": "extend", "requested_added_tokens": 2, "sample_docs": 2, "fertility": 0, "base_vocab_size": 2, "tokens_added": 2, "final_vocab_size": 4}
    longer = {r["token"]: r["id"] for r in spark.read.parquet(str(here / "work/artifacts/tokenizer/vocabulary")).collect()}
    assert longer == {"a": 0, "b": 1, "c": 2, "d": 3} and card("tokenizer")["fertility"]["base"] == 1
    blocks = spark.read.parquet(str(here / "work/artifacts/pretrain/blocks")).collect()
    assert card("pretrain")["blocks"] == len(blocks) == 1 and len(blocks[0]["tokens"]) == 64 and card("pretrain")["seq_len"] == 64
    texts = [r["text"] for r in spark.read.json(str(here / "work/artifacts/finetune/texts")).collect()]
    assert card("finetune")["examples"] == len(texts) == 1 and texts[0].startswith("<|im_start|>user\nhello<|im_end|>")


def test_benchmark_rows_of_a_hub(spark, here):
    class Hub:
        def names(self, path):
            return ["mde_Latn", "eng_Latn"]

        def __call__(self, spark, path, name, split):
            if "belebele" in path:
                return spark.createDataFrame([("p", "q", "1", "a long one", "b", "c", "d")], "flores_passage string, question string, correct_answer_num string, mc_answer1 string, mc_answer2 string, mc_answer3 string, mc_answer4 string")
            return spark.createDataFrame([(i, f"{name} {split} {i}") for i in range(2)], "id long, text string")

    project = project_file(here, evaluate={"benchmarks": ["belebele", "flores"], "limit": 5}, stages=["evaluate"])
    Run(spark, project, "token", fetch={"hub": Hub()}, scorers={"adapted": Echo()}).stages()
    got = json.loads((here / "work/artifacts/evaluate/report_card.json").read_text())
    assert got["results"]["belebele"]["adapted"]["value"] == 1.0 and got["results"]["flores"]["adapted"]["n"] == 2 and got["coverage"]["flores"]["available"]


def test_reviews_of_pairs_are_kept(spark, here):
    sets = [{"repo": str(here / "pairs.jsonl")}]
    go = lambda: Run(spark, project_file(here, convdata={"native_sets": sets, "review": True}, stages=["convdata"])).stages(force_from="convdata")
    go()
    card = lambda: json.loads((here / "work/artifacts/convdata/convdata_card.json").read_text())
    assert card()["accepted"] == 0
    for part in (here / "work/artifacts/convdata/review_queue").glob("part-*.json"):
        part.write_text(part.read_text().replace('"pending"', '"accepted"'))
    go()
    assert card()["accepted"] == 1


def test_hub_sets_and_catalogue(spark, here):
    def hub(spark, path, split, **more):
        if "oasst" in path:
            return spark.createDataFrame([("a", None, "prompter", "ask"), ("b", "a", "assistant", "answer"), ("c", "b", "assistant", "deeper")], "message_id string, parent_id string, role string, text string")
        assert path == "tatsu-lab/alpaca" and split == "train"
        return spark.createDataFrame([("do", "done"), ("", "x")], "instruction string, output string")

    project = project_file(here, convdata={"translate": ["alpaca", "oasst1"], "translate_backend": "mock", "review": False}, stages=["convdata"])
    Run(spark, project, fetch={"hub": hub}).stages()
    pairs = spark.read.json(str(here / "work/artifacts/convdata/pairs")).orderBy("ord").collect()
    assert [(p["instruction"], p["response"]) for p in pairs] == [("[Made] do", "[Made] done"), ("[Made] ask", "[Made] answer")]
    assert [s.connector for s in P.language("cornish").sources][-2:] == ["local", "fineweb2"] and "commoncrawl" in [s.connector for s in P.language("welsh").sources]
    native = P.language("nepali").instruction_sources
    assert [(n.select_value, n.limit) for n in native] == [("npi", 5000)] and not P.language("welsh").instruction_sources
    assert sum(bool(P.language(x).instruction_sources) for x in P.slugs("language") if x != "made") == 16


def test_a_project_by_uri(spark, here, monkeypatch):
    uri = f"file://{here}/far away"
    project = project_file(here, workdir=uri)
    monkeypatch.chdir(here)
    assert set(Run(spark, project).stages().values()) == {"ran"} and set(Run(spark, project).stages().values()) == {"skipped"}
    assert json.loads((here / "far away/artifacts/clean/data_card.json").read_text())["docs_out"] == 2
    manifest = json.loads((here / "far away/.weft/manifest.json").read_text())
    assert all(out.startswith(uri) for stage in manifest["stages"].values() for out in stage["outputs"])
    assert sorted(p.name for p in here.iterdir()) == ["configs", "far away", "in", "p.yaml", "pairs.jsonl"]


def test_a_folder_of_one_machine_is_refused_on_a_cluster(spark, here):
    class Cluster:
        class sparkContext:
            master = "spark://host:7077"

    assert uris.located(Cluster, "hdfs://name/x/") == "hdfs://name/x"
    with pytest.raises(ValueError, match="share"):
        uris.located(Cluster, "/data/x")


def with_sources(here, sources, **ingest):
    """A project of these sources that only ingests."""
    project_file(here, ingest={"sources": [s["connector"] for s in sources], **ingest}, stages=["ingest"])
    spoken = {"display_name": "Made", "iso639_3": "mde", "scripts": ["Latin"], "sources": sources}
    (here / "configs/languages/made.yaml").write_text(yaml.safe_dump(spoken))
    return P.load_project(here / "p.yaml")


def test_a_failing_source_leaves_the_others(spark, here):
    params = {"wikipedia": {"wiki": "cy"}, "glot500": {"glot": "x"}, "culturax": {"lang": "cy"}, "fineweb2": {"lang_script": "x"}, "commoncrawl": {"url_pattern": "a/*", "crawl": "C"}, "local": {"path": str(here / "in")}}
    project = with_sources(here, [{"connector": c, "params": p} for c, p in params.items()])

    def in_a_task(spark, **where):
        @F.udf("string")
        def fail(x):
            raise LookupError("this row can't be read")

        return spark.range(5).select(fail(F.col("id").cast("string")).alias("text"))

    def in_planning(spark, **where):
        raise LookupError("no such set")

    fetch = {"wikipedia": lambda spark, **where: spark.createDataFrame([("a page of an encyclopedia",), ("another",)], "text string"), "glot500": in_planning, "fineweb2": in_a_task, "commoncrawl": lambda *_: (403, b"")}
    Run(spark, project, fetch=fetch).stages()
    card = json.loads((here / "work/artifacts/ingest/ingest_card.json").read_text())
    assert card["mono_docs"] == 6 and {k: v["docs"] for k, v in card["per_source"].items()} == {"wikipedia": 2, "local": 4} and not card["budget_hit"]
    told = {r["source"]: (r["n_docs"], r["notes"]) for r in json.loads((here / "work/.weft/manifest.json").read_text())["provenance"]}
    assert told["wikipedia"] == (2, None) and told["local"] == (4, None) and told["glot500"] == (0, "failed: LookupError: no such set")
    assert told["culturax"][1].startswith("gated: ") and "this row can't be read" in told["fineweb2"][1] and "1 requests failed" in told["commoncrawl"][1]
    ids = [int(json.loads(x)["meta"]["doc_id"]) for p in (here / "work/artifacts/ingest/corpus").glob("*.gz") for x in gzip.open(p, "rt")]
    assert sorted(ids) == list(range(6))


def test_a_full_budget_ends_all_sources_and_opens_no_more_files(spark, here, monkeypatch):
    monkeypatch.setattr(planned.Waves.__init__, "__defaults__", (100,))
    many = here / "many"
    many.mkdir()
    for i in range(8):
        (many / f"{i}.txt").write_text(f"text {i} " * 100)
    (many / "9.jsonl.gz").write_bytes(b"no gzip at all" * 200)  # whoever opens it fails
    asked = []

    def later(*_, **__):
        asked.append(1)
        raise AssertionError("asked for after the budget was full")

    project = with_sources(here, [{"connector": "local", "params": {"path": str(many)}}, {"connector": "opus", "params": {"src": "cy"}}, {"connector": "wikipedia", "params": {"wiki": "cy"}}], max_gb=1500e-9)
    opened = []
    monkeypatch.setattr(registry, "read_local", lambda spark, path, *a, read=registry.read_local: opened.append(path) or read(spark, path, *a))
    Run(spark, project, fetch={"opus": later, "wikipedia": later}).stages()
    card = json.loads((here / "work/artifacts/ingest/ingest_card.json").read_text())
    # 700 bytes a text: the third reaches the budget, as in an order of paths
    assert card["budget_hit"] and card["mono_docs"] == 3 and card["mono_bytes"] == 2100 and card["parallel_docs"] == 0 and not asked
    assert sum(map(len, opened)) <= 4 and not any("9.jsonl" in p for paths in opened for p in paths)
    assert [r["source"] for r in json.loads((here / "work/.weft/manifest.json").read_text())["provenance"]] == ["local"]


def test_too_short_a_corpus_stops_pretrain(spark, here):
    project = project_file(here, stages=["ingest", "clean", "pretrain"])
    for f in (here / "in").iterdir():
        f.write_text("a few words")
    with pytest.raises(ValueError, match="0 tokens"):
        Run(spark, project).stages()
    stages = json.loads((here / "work/.weft/manifest.json").read_text())["stages"]
    assert list(stages) == ["ingest", "clean"]
