"""A project's stages over its folder: corpus shards, chat pairs, coverage, export and a card for each."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import asdict, dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from weft import uris
from weft.log import logger
from weft.operators import benchmarks, chat, clean, evaluation, licensing, tokens
from weft.plans import manifest as M
from weft.plans.corpus import clean_corpus
from weft.plans.ingest import Ingest
from weft.plans.profiles import Project, Source, language, profile
from weft.sources import remote
from weft.sources.files import read_shards

PROVENANCE = "source string, license string, url string"
#: Benchmarks that any language can have, and those that need a configuration of its code.
ALWAYS, CODED = ("native_cloze", "perplexity"), ("belebele", "global_mmlu", "flores")
# The data sets of benchmarks.
BENCHMARK_SETS = {"belebele": "facebook/belebele", "global_mmlu": "CohereForAI/Global-MMLU", "flores": remote.FLORES}
#: How many documents tell how well a tokenizer fits a language.
FERTILITY_DOCS = 2000
# Short names of hub sets of instructions, with their fields.
HUB_SETS = {"dolly": ("databricks/databricks-dolly-15k", "instruction", "response"), "alpaca": ("tatsu-lab/alpaca", "instruction", "output"), "oasst1": ("OpenAssistant/oasst1", None, None)}
#: How many documents of the cleaned corpus synthetic pairs are about.
CONTEXTS = 20


def write_card(path: str, card: dict) -> None:
    uris.write(path, json.dumps(card, indent=2, ensure_ascii=False, default=str))


def write_lines(rows: DataFrame, path: str) -> int:
    """JSON lines that people may edit, and how many: a local folder keeps no checksums of its files, which an edit would break."""
    seen = Observation()
    rows.observe(seen, F.count("*").alias("n")).write.mode("overwrite").json(path)
    uris.drop_checksums(path)
    return seen.get["n"]


@dataclass
class Run:
    """A project with what stands in for the network and for models.

    ``fetch`` gives rows or answers by connector name, and rows of hub sets of instructions under ``hub``;
    ``configs`` (benchmark, code, gated) are the configurations there are. ``identifiers`` by language-ID backend,
    ``translators`` (text, language name) and ``teachers`` (like ``chat.mock_pairs``) by backend or provider,
    ``scorers`` (base, adapted, judge; see ``operators.benchmarks``) and ``items`` of benchmarks do the work of
    models; ``tokenizers`` (base, trained; see ``functions.tokenizers``) count and pack tokens. A project that asks
    for what isn't here gets a note in its card.
    """

    spark: SparkSession
    project: Project
    token: str | None = None
    fetch: dict[str, Callable[..., DataFrame]] = field(default_factory=dict)
    configs: DataFrame | None = None
    translators: dict[str, Callable[[Column, str], Column]] = field(default_factory=lambda: {"mock": chat.mock_translate})
    teachers: dict[str, Callable[..., DataFrame]] = field(default_factory=lambda: {"mock": chat.mock_pairs})
    identifiers: dict[str, object] = field(default_factory=dict)
    scorers: dict[str, object] = field(default_factory=dict)
    items: dict[str, object] = field(default_factory=dict)
    tokenizers: dict[str, object] = field(default_factory=dict)

    def __post_init__(self):
        self.folder = uris.located(self.spark, self.project.folder)
        self.manifest = M.Manifest.load(uris.join(self.folder, ".weft", "manifest.json"))

    def at(self, stage: str, *more: str) -> str:
        """A URI below the project's artifacts: Spark writes there, and every stage and executor can read it."""
        return uris.join(self.folder, "artifacts", stage, *more)

    def stages(self, selected: list[str] | None = None, force_from: str | None = None) -> dict[str, str]:
        """What became of each stage: ran or skipped."""
        project = self.project
        config = {s: asdict(getattr(project, s)) for s in M.STAGES}
        config["ingest"]["catalog"] = [asdict(s) for s in project.sources]
        config["ingest"]["local_files"] = local_files(project.sources)
        config["clean"]["language"] = asdict(language(project.language).normalization)
        work = {s: getattr(self, f"_{s}", None) or (lambda s=s: self._planned(s)) for s in M.STAGES}
        return M.run(self.manifest, selected or project.selected, config, work, force_from)

    # ---- stages: each gives its outputs and metrics
    def _ingest(self):
        cfg = self.project.ingest
        work = Ingest(self.spark, self.at("ingest"), int(cfg.max_gb * 1e9) if cfg.max_gb else None, cfg.max_docs_per_source, self.token, self.fetch)
        records = work.run(self.project.sources)
        self.manifest.add_provenance(records)
        card = {"language": self.project.language, "skipped": work.skipped, "per_source": work.per_source, "budget_hit": work.full, "used_token": self.token is not None}
        card |= {"mono_docs": work.docs["mono"], "mono_bytes": work.bytes["mono"], "parallel_docs": work.docs["parallel"]}
        write_card(self.at("ingest", "ingest_card.json"), card)
        outputs = [self.at("ingest", folder) for kind, folder in (("mono", "corpus"), ("parallel", "parallel")) if work.docs[kind]]
        return outputs, {"mono_docs": card["mono_docs"], "parallel_docs": card["parallel_docs"], "sources": len(records)}

    def _corpus(self, stage: str) -> DataFrame | None:
        path = self.at(stage, "corpus")
        if not uris.exists(path):
            return None
        # shards say the place of each document, so later stages order as ingest did
        return read_shards(self.spark, path).withColumn("doc_id", F.try_element_at("meta", F.lit("doc_id")).cast("long"))

    def _clean(self):
        docs, cfg, profile_ = self._corpus("ingest"), self.project.clean, language(self.project.language)
        if docs is None:
            write_card(self.at("clean", "data_card.json"), {"docs_in": 0, "docs_out": 0, "tokens_out": 0})
            return [], {"docs_in": 0, "docs_out": 0, "tokens_out": 0}
        rules = {"form": profile_.normalization.unicode_form, "digits": profile_.normalization.normalize_digits, "rules": tuple(profile_.normalization.rules)}
        out, model, said = self.at("clean", "corpus"), self.identifiers.get(cfg.lang_id), "off"
        if model is not None:
            rules |= {"language": profile_.iso639_3, "min_prob": cfg.min_doc_lang_prob, "model": model}
            said = f"on ({cfg.lang_id})"
        elif cfg.lang_id != "none":
            said = f"off (no {cfg.lang_id} model here)"
            logger("clean").warning("texts are not filtered by language: no %s model here", cfg.lang_id)
        card = {"language_filter": said} | clean_corpus(self.spark, docs, out, min_quality=cfg.min_quality, near=cfg.dedup == "minhash", exact=cfg.dedup != "none", scrub=cfg.scrub_pii, **rules)
        write_card(self.at("clean", "data_card.json"), card)
        return [out], {k: card[k] for k in ("docs_in", "docs_out", "tokens_out")}

    def _tokenizer(self):
        """How many tokens a word takes with the base tokenizer, and which tokens of a trained one it lacks; nothing is trained here."""
        cfg, docs, base, trained = self.project.tokenizer, self._corpus("clean"), self.tokenizers.get("base"), self.tokenizers.get("trained")
        if base is None or docs is None:
            return self._planned("tokenizer")
        sample = clean.stored(self.spark, docs.filter("text <> ''").orderBy("doc_id").limit(FERTILITY_DOCS), "sample")
        card = {"strategy": cfg.strategy, "requested_added_tokens": cfg.added_tokens, "sample_docs": sample.count(), "fertility": {"base": tokens.fertility(sample, base).first()["fertility"]}}
        vocabulary, outputs = base.vocabulary(self.spark), []
        card |= {"base_vocab_size": vocabulary.count(), "tokens_added": 0}
        card["final_vocab_size"] = card["base_vocab_size"]
        if trained is not None and cfg.strategy != "none":
            card["fertility"]["trained"] = tokens.fertility(sample, trained).first()["fertility"]
            novel = tokens.novel_tokens(trained.vocabulary(self.spark), vocabulary, cfg.added_tokens)
            longer = tokens.extension(vocabulary, novel) if cfg.strategy == "extend" else trained.vocabulary(self.spark)
            outputs = [self.at("tokenizer", "vocabulary")]
            seen = Observation()
            longer.observe(seen, F.count("*").alias("n")).write.mode("overwrite").parquet(outputs[0])
            # an extension has the base vocabulary and what was added
            card |= {"final_vocab_size": seen.get["n"], "tokens_added": seen.get["n"] - card["base_vocab_size"] if cfg.strategy == "extend" else 0}
        write_card(self.at("tokenizer", "tokenizer_card.json"), card)
        return [self.at("tokenizer", "tokenizer_card.json"), *outputs], {"fertility": card["fertility"]["base"], "tokens_added": card["tokens_added"]}

    def _pretrain(self):
        """Blocks of tokens that a trainer would read, as Parquet; training itself is only planned."""
        docs, cfg, compute = self._corpus("clean"), self.project.pretrain, profile("compute", self.project.compute)
        outputs, metrics = self._planned("pretrain")
        if docs is None:
            return outputs, metrics
        tokenizer = self.tokenizers.get("base")
        wanted = min(cfg.seq_len, compute.max_seq_len_cap or cfg.seq_len)
        total = tokens.token_total(docs, tokenizer)
        length = tokens.fitting_length(total, wanted)
        if length is None:
            raise ValueError(f"the cleaned corpus has {total} tokens, too few for one block: add sources or lower clean.min_quality")
        most = tokens.block_budget(cfg.max_steps, compute.per_device_batch_size, compute.gradient_accumulation_steps) if cfg.max_steps else None
        out, seen = self.at("pretrain", "blocks"), Observation()
        tokens.packed(self.spark, docs, length, most, tokenizer).observe(seen, F.count("*").alias("n")).write.mode("overwrite").parquet(out)
        n = seen.get["n"]
        path = self.at("pretrain", "pretrain_card.json")
        write_card(path, json.loads(uris.read(path)) | {"status": "packed, not trained", "seq_len": length, "blocks": n, "max_blocks": most, "tokens": n * length})
        return [*outputs, out], {"status": "packed", "blocks": n}

    def _finetune(self):
        """Accepted pairs as the chat text that a trainer would read; training itself is only planned."""
        outputs, metrics = self._planned("finetune")
        path = self.at("convdata", "accepted")
        rows = self.spark.read.json(path) if uris.exists(path) else None
        if rows is None or "messages" not in rows.columns:
            return outputs, metrics | {"examples": 0}
        out = self.at("finetune", "texts")
        n = write_lines(rows.select(chat.chatml("messages").alias("text")), out)
        card = self.at("finetune", "finetune_card.json")
        write_card(card, json.loads(uris.read(card)) | {"status": "formatted, not trained", "examples": n})
        return [*outputs, out], {"status": "formatted", "examples": n}

    def _translated(self, skipped: dict) -> list[DataFrame]:
        """Pairs of the instruction files to translate; ``skipped`` says why some give none."""
        cfg, name, parts = self.project.convdata, language(self.project.language).display_name, []
        backend = cfg.provider if cfg.translate_backend == "teacher" else cfg.translate_backend
        translate = self.translators.get(backend)
        for path in cfg.translate:
            got = None if translate is None else self._instructions(path, cfg.translate_limit)
            if got is None:
                skipped[f"translate:{path}"] = f"no translator {backend} here" if translate is None else "neither a local file nor a hub set that can be fetched"
                continue
            parts.append(got.select("ord", *(translate(F.col(c), name).alias(c) for c in ("instruction", "response")), F.lit(f"translate:{path}").alias("source")))
        return parts

    def _instructions(self, name: str, limit: int | None) -> DataFrame | None:
        """Pairs of a local file, else of a hub set by its short name or id; None if it can't be had."""
        if uris.is_file(name):
            return chat.instruction_set(self.spark.read.json(name).withColumn("ord", F.monotonically_increasing_id()), limit)
        if "hub" not in self.fetch:
            return None
        repo, instruction, response = HUB_SETS.get(name, (name, "instruction", "response"))
        rows = self.fetch["hub"](self.spark, path=repo, split="train").withColumn("ord", F.monotonically_increasing_id())
        if repo == HUB_SETS["oasst1"][0]:
            roles = F.when(F.col("role") == "prompter", "user").otherwise(F.col("role"))
            got = chat.replies(rows.withColumn("role", roles)).select("ord", "instruction", "response").orderBy("ord")
            return got if limit is None else got.limit(limit)
        return chat.native_set(rows, instruction, response, limit=limit)

    def _native(self, skipped: dict) -> list[DataFrame]:
        parts = []
        for s in [*language(self.project.language).instruction_sources, *self.project.convdata.native_sets]:
            if not uris.is_file(s.repo) and "hub" not in self.fetch:
                skipped[f"native:{s.repo}"] = "neither a local file nor a hub set that can be fetched"
                continue
            rows = self.spark.read.json(s.repo) if uris.is_file(s.repo) else self.fetch["hub"](self.spark, path=s.repo, split=s.split, **({"name": s.name} if s.name else {}))
            rows = rows.withColumn("ord", F.monotonically_increasing_id())
            select = (s.select_field, s.select_value) if s.select_field else None
            got = chat.native_set(rows, s.instruction_field, s.response_field, s.source_field if s.source_field in rows.columns else None, tuple(s.exclude), select, s.limit)
            parts.append(got.withColumn("source", F.lit(f"native:{s.repo}")))
        return parts

    def _synthetic(self, skipped: dict) -> list[DataFrame]:
        """Pairs of the teacher, about the first documents of the cleaned corpus if they are to be."""
        synth = self.project.convdata.synth
        if not synth or not synth.n:
            return []
        teacher = self.teachers.get(synth.provider)
        if teacher is None:
            skipped["synth"] = f"no teacher {synth.provider} here"
            return []
        docs = self._corpus("clean") if synth.ground_in_corpus else None
        about: tuple = ()
        if docs is not None:
            first = tokens.positional(docs.select("doc_id", "text"), "doc_id", CONTEXTS)
            contexts = clean.stored(self.spark, first.select(F.col("pos").alias("i"), F.col("text").alias("context")), "contexts")
            about = (contexts, contexts.count())
        pairs = teacher(self.spark, synth.n, language(self.project.language).display_name, *about)
        return [pairs.select(F.col("i").alias("ord"), "instruction", "response", F.lit("synth").alias("source"))]

    def _convdata(self):
        cfg, skipped = self.project.convdata, {}
        parts = [*self._translated(skipped), *self._native(skipped), *self._synthetic(skipped)]
        parts = [p.withColumn("branch", F.lit(i)) for i, p in enumerate(parts)]
        outputs = [self.at("convdata", n) for n in ("pairs", "review_queue", "accepted")]
        metrics = {"generated": 0, "degenerate_dropped": 0, "deduped": 0, "accepted": 0}
        if parts:
            rows = reduce(DataFrame.unionByName, parts)
            rows = clean.running_total(self.spark, rows.withColumns({"one": F.lit(1), "place": F.struct("branch", "ord")}).drop("ord"), "place", "one", "ord")
            judged = chat.pair_status(rows)
            n = {r["status"]: r["count"] for r in judged.groupBy("status").count().collect()}
            good = judged.filter("status = 'accepted'").select("ord", "source", "instruction", "response")
            queue = chat.review_queue(self.spark, good)
            if uris.exists(outputs[1]):
                queue = chat.merge_reviews(queue, self.spark.read.json(outputs[1]).select("id", "status"))
            queue = clean.stored(self.spark, queue.drop("ord").withColumn("messages", chat.messages(F.col("instruction"), F.col("response"))), "queue")
            accepted = chat.accepted_pairs(queue, cfg.review)
            written = [write_lines(df, out) for out, df in zip(outputs, (good, queue, accepted))]
            metrics = {"generated": sum(n.values()), "degenerate_dropped": n.get("degenerate", 0), "deduped": n.get("accepted", 0), "accepted": written[2]}
        write_card(self.at("convdata", "convdata_card.json"), metrics | ({"skipped": skipped} if skipped else {}))
        return outputs if parts else [], {k: metrics[k] for k in ("accepted", "deduped")}

    def _coverage(self) -> dict[str, dict]:
        """For each benchmark of the project whether it applies to the language, and why not."""
        spoken, out = language(self.project.language), {}
        codes = spoken.benchmark_codes()
        wanted = [b for b in self.project.evaluate.benchmarks if b in CODED]
        told, configs = {}, self.configs
        names = getattr(self.fetch.get("hub"), "names", None)
        if wanted and configs is None and names:
            known = [(b, c, benchmarks.benchmark(b).gated) for b in wanted for c in names(BENCHMARK_SETS[b])]
            configs = self.spark.createDataFrame(known, "benchmark string, code string, gated boolean")
        if wanted and configs is not None:
            asked = self.spark.createDataFrame([(spoken.name, b, codes[b]) for b in wanted], "language string, benchmark string, code string")
            told = {r["benchmark"]: r["reason"] for r in evaluation.coverage(asked, configs).collect()}
            if self.token:
                told = {b: "covered" if why == "gated" else why for b, why in told.items()}
        for b in self.project.evaluate.benchmarks:
            if b in ALWAYS:
                why = "covered"
            elif b == "judge":
                why = "covered" if self._accepted() is not None else "no accepted pairs"
            elif b in CODED:
                why = told.get(b, "no list of configurations")
            else:
                why = "unknown benchmark"
            out[b] = {"available": why == "covered", "reason": why, "resolved_code": codes.get(b), "gated": b in benchmarks.BENCHMARKS and benchmarks.benchmark(b).gated}
        return out

    def _accepted(self) -> DataFrame | None:
        """(id, instruction) of the accepted chat pairs, in their order."""
        path = self.at("convdata", "accepted")
        if not uris.exists(path):
            return None
        rows = self.spark.read.json(path)
        return rows.select(F.monotonically_increasing_id().alias("id"), "instruction").filter("instruction <> ''") if "instruction" in rows.columns else None

    def _items(self, name: str):
        """Rows of a benchmark: those given, else those of its data set in the language's code."""
        if name in self.items or name not in CODED or "hub" not in self.fetch:
            return self.items.get(name)
        code = language(self.project.language).benchmark_codes()[name]
        rows = lambda split, c=code: self.fetch["hub"](self.spark, path=BENCHMARK_SETS[name], name=c, split=split)
        if name == "flores":
            return tuple(tuple(rows(split, c).select("id", "text") for c in ("eng_Latn", code)) for split in ("dev", "devtest"))
        place = F.monotonically_increasing_id().alias("id")
        if name == "belebele":
            answers = [F.col(f"mc_answer{i}").alias(f"answer{i}") for i in range(1, 5)]
            return rows("test").select(place, F.col("flores_passage").alias("passage"), "question", F.col("correct_answer_num").alias("number"), *answers)
        return rows("test").select(place, "question", "answer", *(f"option_{x}" for x in "abcd"))

    def _scored(self, name: str, scorer) -> dict | None:
        """value, n, lo and hi of one model, or None where what it needs isn't here."""
        limit, spoken = self.project.evaluate.limit, language(self.project.language).display_name
        docs, items = self._corpus("clean"), self._items(name)
        if name == "native_cloze" and docs is not None:
            got = benchmarks.cloze(scorer, docs, limit)
        elif name == "perplexity" and docs is not None:
            got = benchmarks.perplexity(self.spark, scorer, docs, limit)
        elif name == "belebele" and items is not None:
            got = benchmarks.multiple_choice(scorer, evaluation.passage_items(items), limit)
        elif name == "global_mmlu" and items is not None:
            got = benchmarks.multiple_choice(scorer, evaluation.letter_items(items), limit)
        elif name == "flores" and items is not None:
            got = benchmarks.translation(scorer, *items, spoken, limit)
        elif name == "judge" and "judge" in self.scorers:
            got = benchmarks.judged(scorer, self.scorers["judge"], self._accepted(), spoken, limit)
        else:
            return None
        row = got.first()
        return row.asDict() if row else None

    def _evaluate(self):
        covered, results, summary = self._coverage(), {}, {}
        for name, cover in covered.items():
            if not cover["available"]:
                summary[name] = f"not covered: {cover['reason']}"
                continue
            kind, scores = benchmarks.benchmark(name), {}
            for bundle in ("adapted", "base"):
                scorer = self.scorers.get(bundle)
                if scorer is None or bundle == "base" and not kind.compare_to_base:
                    continue
                try:
                    scores[bundle] = self._scored(name, scorer)
                except Exception as why:  # one benchmark that fails doesn't end the report
                    logger("evaluate").warning("%s failed on %s: %s", name, bundle, why)
            value = lambda b: (scores.get(b) or {}).get("value")
            delta = benchmarks.gain(name, value("base"), value("adapted"))
            results[name] = {**scores, "delta": delta, "lower_is_better": kind.lower_is_better, "caveat": kind.caveat}
            summary[name] = benchmarks.told(name, scores.get("adapted"), delta) if self.scorers else "not measured (no model here)"
        card = {"language": self.project.language, "coverage": covered, "results": results, "summary": summary, "human_review": self._output_review()}
        write_card(self.at("evaluate", "report_card.json"), card)
        return [self.at("evaluate", "report_card.json")], {"summary": summary}

    def _output_review(self) -> dict | None:
        """Replies of the adapted model to accepted instructions as a queue that people rate; what they rated before stays."""
        cfg, prompts, scorer = self.project.evaluate, self._accepted(), self.scorers.get("adapted")
        if not cfg.human_review:
            return None
        if prompts is None or scorer is None:
            return {"status": "skipped: no accepted pairs" if prompts is None else "skipped: no model here"}
        first = tokens.positional(prompts, "id", cfg.human_review_n).select(F.col("pos").alias("id"), "instruction", F.col("instruction").alias("prompt"))
        queue = chat.output_queue(scorer.replies(first))
        out = self.at("evaluate", "human_review_queue.jsonl")
        if uris.exists(out):
            queue = chat.merge_output_reviews(queue, self.spark.read.schema(chat.OUTPUT_QUEUE).json(out))
        queue = clean.stored(self.spark, queue, "queue")
        # bounded by human_review_n, and one plain file for those who rate
        lines = [json.dumps(r.asDict(), ensure_ascii=False) for r in queue.orderBy("id").collect()]
        uris.write(out, "".join(x + "\n" for x in lines))
        row = evaluation.review_summary(queue).first().asDict()
        return row | ({} if row["reviewed"] else {"status": "awaiting review"})

    def _export(self):
        records = [(r["source"], r.get("license"), r.get("url")) for r in self.manifest.provenance]
        provenance = self.spark.createDataFrame(records, PROVENANCE)
        licence, why = licensing.release(provenance)
        credits = [r["line"] for r in licensing.attributions(provenance).orderBy("source").collect()]
        model, spoken = profile("model", self.project.base_model), language(self.project.language)
        report = self.at("evaluate", "report_card.json")
        scores = json.loads(uris.read(report)).get("summary", {}) if uris.exists(report) else {}
        uris.write(self.at("export", "MODEL_CARD.md"), model_card(self.project, spoken.display_name, model.hf_id, f"{licence}: {why}.", scores, credits))
        if self.project.export.make_ollama_modelfile:
            uris.write(self.at("export", "Modelfile"), modelfile(model.hf_id, spoken.display_name))
        write_card(self.at("export", "export_card.json"), {"model_kind": "base", "model_license": licence, "license_rationale": why, "attributions": credits, "evals": scores, "quantize": self.project.export.quantize})
        return [self.at("export")], {"model_kind": "base", "license": licence}

    def _planned(self, stage: str):
        """Stages that train a model only say with what they would."""
        card = {"status": "planned", "base_model": profile("model", self.project.base_model).hf_id, **asdict(getattr(self.project, stage))}
        cap = profile("compute", self.project.compute).max_seq_len_cap
        for key in ("seq_len", "max_seq_len"):
            if key in card and cap:
                card[key] = min(card[key], cap)
        out = self.at(stage, f"{stage}_card.json")
        write_card(out, card)
        return [out], {"status": "planned"}


def local_files(sources: list[Source]) -> list[list]:
    """Path, size and time of change of every file of the local sources, so that a changed corpus is read again; listed, not opened."""
    roots = [s.params["path"] for s in sources if s.connector == "local" and s.params.get("path")]
    return [[f.path, f.size, int(f.mtime.timestamp()) if f.mtime else None] for root in roots for f in uris.files(root)]


def modelfile(model: str, name: str) -> str:
    lines = ["# local model file", f"FROM {model}", "PARAMETER temperature 0.7", f'SYSTEM "Answer in {name}."']
    return "\n".join(lines) + "\n"


def model_card(project: Project, name: str, base: str, licence: str, scores: dict, credits: list[str]) -> str:
    """Markdown for a release: what it is made of, how it scored, its licence and whom to credit."""
    bullets = lambda items, none: "\n".join(f"- {x}" for x in items) or f"- {none}"
    parts = [
        f"# {project.name}",
        f"A model for {name}, made from `{base}`.",
        "## Scores\n\n" + bullets((f"{k}: {v}" for k, v in scores.items()), "none were measured"),
        "## Limits\n\nLittle text teaches little: have speakers of the language review what it says before it is used.",
        f"## Licence\n\n{licence}",
        "## Sources\n\n" + bullets(credits, "none recorded"),
    ]
    return "\n\n".join(parts) + "\n"
