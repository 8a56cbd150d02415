"""Profiles of languages, base models and compute, and the project that names one of each.

Profiles are looked for as ``<root>/{languages,models,compute}/<slug>.yaml`` under the roots of
$WEFT_CONFIG_PATH, then under ./configs; the first found wins. What no file describes is made from the
tables below. Unknown keys, wrong choices and values out of range are refused.
"""

from __future__ import annotations

import os
from dataclasses import MISSING, dataclass, field, fields, is_dataclass
from pathlib import Path
from typing import Any

import yaml

from weft.plans.manifest import STAGES

# Script tags (ISO 15924).
SCRIPT_TAGS = {
    "Latin": "Latn",
    "Arabic": "Arab",
    "Cyrillic": "Cyrl",
    "Ethiopic": "Ethi",
    "Devanagari": "Deva",
    "Sinhala": "Sinh",
    "Tibetan": "Tibt",
    "Khmer": "Khmr",
    "Hebrew": "Hebr",
    "Greek": "Grek",
    "Armenian": "Armn",
    "Georgian": "Geor",
    "Hangul": "Hang",
    "Thai": "Thai",
    "Bengali": "Beng",
    "Tamil": "Taml",
}
# Codes of web-text configurations that differ from <iso639_3>_<script>.
WEB_TEXT_CODES = {"grn": "gug_Latn", "mon": "khk_Cyrl", "nep": "npi_Deva", "pus": "pbt_Arab", "que": "quy_Latn", "swa": "swh_Latn"}
# Translation codes that differ from <iso639_3>_<script>; None where there is none.
TRANSLATION_CODES = {"bre": None, "cor": None, "fas": "pes_Arab", "mon": "khk_Cyrl", "nep": "npi_Deva", "pus": "pbt_Arab", "que": "quy_Latn", "swa": "swh_Latn"}
# Slug, iso639_3, iso639_1, script.
LANGUAGES = (
    ("amharic", "amh", "am", "Ethiopic"),
    ("basque", "eus", "eu", "Latin"),
    ("breton", "bre", "br", "Latin"),
    ("cornish", "cor", "kw", "Latin"),
    ("faroese", "fao", "fo", "Latin"),
    ("farsi", "fas", "fa", "Arabic"),
    ("galician", "glg", "gl", "Latin"),
    ("guarani", "grn", "gn", "Latin"),
    ("haitian_creole", "hat", "ht", "Latin"),
    ("hausa", "hau", "ha", "Latin"),
    ("igbo", "ibo", "ig", "Latin"),
    ("irish", "gle", "ga", "Latin"),
    ("khmer", "khm", "km", "Khmer"),
    ("kurmanji", "kmr", "ku", "Latin"),
    ("luxembourgish", "ltz", "lb", "Latin"),
    ("maltese", "mlt", "mt", "Latin"),
    ("maori", "mri", "mi", "Latin"),
    ("mongolian", "mon", "mn", "Cyrillic"),
    ("nepali", "nep", "ne", "Devanagari"),
    ("occitan", "oci", "oc", "Latin"),
    ("pashto", "pus", "ps", "Arabic"),
    ("quechua", "que", "qu", "Latin"),
    ("scottish_gaelic", "gla", "gd", "Latin"),
    ("sinhala", "sin", "si", "Sinhala"),
    ("somali", "som", "so", "Latin"),
    ("sorani", "ckb", None, "Arabic"),
    ("swahili", "swa", "sw", "Latin"),
    ("tibetan", "bod", "bo", "Tibetan"),
    ("uyghur", "uig", "ug", "Arabic"),
    ("welsh", "cym", "cy", "Latin"),
    ("xhosa", "xho", "xh", "Latin"),
    ("yoruba", "yor", "yo", "Latin"),
    ("zulu", "zul", "zu", "Latin"),
)
# Names and normalization rules that don't follow from the slug.
NAMES = {"farsi": "Persian (Farsi)", "kurmanji": "Kurmanji Kurdish", "sorani": "Sorani Kurdish"}
RULES = {"farsi": ["arabic_presentation_forms", "persian_yeh_kaf"], "sorani": ["arabic_presentation_forms", "sorani_arabic"], "kurmanji": ["kurdish_latin"], "welsh": ["welsh_digraphs"]}
# Families and dialects.
FAMILIES = {"cornish": "Celtic (Brythonic)", "farsi": "Iranian (Southwestern)", "kurmanji": "Iranian (Northwestern)", "sorani": "Iranian (Northwestern)", "welsh": "Celtic (Brythonic)"}
DIALECTS = {"cornish": ["Standard Written Form"], "farsi": ["Iranian Persian"], "kurmanji": ["Northern Kurdish"], "sorani": ["Central Kurdish"], "welsh": ["Northern", "Southern"]}
# Languages with rows in a public set of instructions written by people.
INSTRUCTED = ("amharic", "basque", "farsi", "haitian_creole", "hausa", "igbo", "irish", "nepali", "pashto", "sinhala", "somali", "sorani", "swahili", "xhosa", "yoruba", "zulu")
INSTRUCTIONS = "CohereForAI/aya_dataset"
# Parallel corpora of most languages, and of those with others.
CORPORA = ["OpenSubtitles", "Tatoeba", "NLLB"]
OTHER_CORPORA = {"cornish": ["Tatoeba", "bible-uedin"], "welsh": ["OpenSubtitles", "Tatoeba", "NLLB", "bible-uedin"]}
# Model slug, hub id, family, context length.
MODELS = (
    ("aya-23-8b", "CohereForAI/aya-23-8B", "aya", 8192),
    ("aya-expanse-8b", "CohereLabs/aya-expanse-8b", "aya", 8192),
    ("bloomz-1b7", "bigscience/bloomz-1b7", "bloom", 2048),
    ("gemma2-2b", "google/gemma-2-2b", "gemma", 8192),
    ("gemma2-9b", "google/gemma-2-9b", "gemma", 8192),
    ("llama3.1-8b", "meta-llama/Llama-3.1-8B", "llama", 131072),
    ("llama3.2-1b", "meta-llama/Llama-3.2-1B", "llama", 131072),
    ("llama3.2-3b", "meta-llama/Llama-3.2-3B", "llama", 131072),
    ("mistral-7b-v0.3", "mistralai/Mistral-7B-v0.3", "mistral", 32768),
    ("phi-3.5-mini", "microsoft/Phi-3.5-mini-instruct", "phi", 131072),
    ("qwen2.5-0.5b", "Qwen/Qwen2.5-0.5B", "qwen", 32768),
    ("qwen2.5-1.5b", "Qwen/Qwen2.5-1.5B", "qwen", 32768),
    ("qwen2.5-3b", "Qwen/Qwen2.5-3B", "qwen", 32768),
    ("qwen2.5-7b", "Qwen/Qwen2.5-7B", "qwen", 32768),
    ("qwen3-1.7b", "Qwen/Qwen3-1.7B-Base", "qwen", 32768),
    ("qwen3-4b", "Qwen/Qwen3-4B-Base", "qwen", 32768),
    ("smollm2-1.7b", "HuggingFaceTB/SmolLM2-1.7B", "smollm", 8192),
    ("smollm2-135m", "HuggingFaceTB/SmolLM2-135M", "smollm", 8192),
    ("smollm2-360m", "HuggingFaceTB/SmolLM2-360M", "smollm", 8192),
    ("tinyllama-1.1b", "TinyLlama/TinyLlama_v1.1", "llama", 2048),
    ("xlmr-base", "FacebookAI/xlm-roberta-base", "xlmr", 512),
)
# Compute profiles that differ from the defaults.
COMPUTE = {
    "a100": {"quantization": "none", "per_device_batch_size": 8, "gradient_accumulation_steps": 4, "max_seq_len_cap": 4096},
    "cluster": {"quantization": "none", "per_device_batch_size": 8, "gradient_accumulation_steps": 2, "distributed": "deepspeed"},
    "colab_t4": {"precision": "fp16", "per_device_batch_size": 4, "gradient_accumulation_steps": 4, "max_seq_len_cap": 512},
    "consumer_gpu": {"max_seq_len_cap": 2048},
}


class ConfigError(ValueError):
    pass


class ProfileNotFound(FileNotFoundError):
    pass


def opt(default: Any = None, *, of: type | None = None, among: tuple = (), low: float | None = None, high: float | None = None):
    """A field with a default; ``of`` is the shape of nested blocks, ``among`` and the bounds are checked."""
    rule = {"of": of, "among": among, "low": low, "high": high}
    if isinstance(default, (list, dict)):
        return field(default_factory=lambda: type(default)(default), metadata=rule)
    if isinstance(default, type):
        return field(default_factory=default, metadata=rule | {"of": default})
    return field(default=default, metadata=rule)


def shaped(shape: type, data: Any, at: str = ""):
    """``data`` as an instance of the dataclass ``shape``, with the place of what is wrong in each error."""
    at = at or shape.__name__
    if not isinstance(data, dict):
        raise ConfigError(f"{at}: a mapping is needed")
    known = {f.name: f for f in fields(shape)}
    if extra := sorted(set(data) - set(known)):
        raise ConfigError(f"{at}: unknown keys {', '.join(map(str, extra))}")
    if missing := [n for n, f in known.items() if n not in data and f.default is MISSING and f.default_factory is MISSING]:
        raise ConfigError(f"{at}: {', '.join(missing)} missing")
    out = {}
    for name, value in data.items():
        rule, where = known[name].metadata, f"{at}.{name}"
        nested = rule.get("of")
        if nested and isinstance(value, list):
            value = [x if is_dataclass(x) else shaped(nested, x, f"{where}[{i}]") for i, x in enumerate(value)]
        elif nested and value is not None and not is_dataclass(value):
            value = shaped(nested, value, where)
        _check(value, rule, where)
        out[name] = value
    return shape(**out)


def _check(value: Any, rule: dict, where: str) -> None:
    if rule.get("among") and value not in rule["among"]:
        raise ConfigError(f"{where}: {value!r} is none of {', '.join(map(str, rule['among']))}")
    for bound, bad in (("low", lambda v, b: v < b), ("high", lambda v, b: v > b)):
        if value is not None and rule.get(bound) is not None and bad(value, rule[bound]):
            raise ConfigError(f"{where}: {value!r} is out of range")


@dataclass
class Source:
    """A connector and its parameters; params.license and params.url are its provenance."""

    connector: str
    params: dict = opt({})
    notes: str | None = None


@dataclass
class NativeSet:
    """A data set of instructions in the language itself."""

    repo: str
    name: str | None = None
    split: str = "train"
    instruction_field: str = "inputs"
    response_field: str = "targets"
    source_field: str = "dataset"
    exclude: list = opt([])
    select_field: str | None = None
    select_value: str | None = None
    limit: int | None = 5000
    notes: str | None = None


@dataclass
class Normalization:
    unicode_form: str = opt("NFC", among=("NFC", "NFD", "NFKC", "NFKD"))
    normalize_digits: bool = False
    rules: list = opt([])


@dataclass
class Language:
    name: str
    display_name: str
    iso639_3: str
    scripts: list
    iso639_1: str | None = None
    nllb_code: str | None = None
    default_script: str | None = None
    direction: str = opt("ltr", among=("ltr", "rtl"))
    family: str | None = None
    dialects: list = opt([])
    sources: list = opt([], of=Source)
    instruction_sources: list = opt([], of=NativeSet)
    normalization: Normalization = opt(Normalization)
    notes: str | None = None

    def __post_init__(self):
        if not self.scripts:
            raise ConfigError("Language.scripts: one at least is needed")
        if all(s.connector != "fineweb2" for s in self.sources):
            code = WEB_TEXT_CODES.get(self.iso639_3, self.code)
            self.sources = [*self.sources, Source("fineweb2", {"fineweb": code, "license": "ODC-BY-1.0"}, "web text, listed for every language")]

    @property
    def code(self) -> str:
        """<iso639_3>_<script tag>; an unlisted script gives its first four letters."""
        script = self.default_script or self.scripts[0]
        return f"{self.iso639_3}_{SCRIPT_TAGS.get(script, script[:4].title())}"

    def benchmark_codes(self) -> dict[str, str | None]:
        return {"belebele": self.code, "global_mmlu": self.iso639_1, "flores": self.nllb_code or self.code}


@dataclass
class Model:
    name: str
    hf_id: str
    family: str
    arch: str = opt("decoder", among=("decoder", "encoder"))
    tokenizer_type: str = "bpe"
    context_length: int = 2048
    chat_template: str | None = None
    good_for_lrl: bool = True  # a key of the file format
    notes: str | None = None


@dataclass
class Compute:
    name: str
    device: str = "cuda"
    precision: str = "bf16"
    quantization: str = opt("4bit", among=("none", "8bit", "4bit"))
    per_device_batch_size: int = 1
    gradient_accumulation_steps: int = 16
    gradient_checkpointing: bool = True
    use_unsloth: bool = False
    distributed: str = opt("none", among=("none", "ddp", "deepspeed", "fsdp"))
    max_seq_len_cap: int | None = None
    notes: str | None = None


@dataclass
class Ingest:
    sources: list = opt([])
    max_gb: float | None = None
    max_docs_per_source: int | None = None


@dataclass
class Clean:
    lang_id: str = opt("glotlid", among=("glotlid", "fasttext", "none"))
    min_doc_lang_prob: float = opt(0.5, low=0, high=1)
    dedup: str = opt("minhash", among=("none", "exact", "minhash"))
    min_quality: float = opt(0.5, low=0, high=1)
    strip_boilerplate: bool = True
    normalize: bool = True
    scrub_pii: bool = True


@dataclass
class Tokenizer:
    strategy: str = opt("extend", among=("extend", "train", "none"))
    added_tokens: int = opt(8000, low=0)


TUNING = ("qlora", "lora", "full")


@dataclass
class Pretrain:
    method: str = opt("qlora", among=TUNING)
    epochs: float = 1.0
    seq_len: int = 2048
    learning_rate: float = 2e-4
    max_steps: int | None = None
    lora_r: int = 32
    lora_alpha: int = 64
    embed_init: str = "subword_mean"


@dataclass
class Synth:
    provider: str = opt("ollama", among=("ollama", "local", "mock"))
    model: str | None = None
    n: int = opt(5000, low=0)
    ground_in_corpus: bool = True


@dataclass
class ConvData:
    translate: list = opt([])
    native_sets: list = opt([], of=NativeSet)
    translate_limit: int | None = 500
    translate_backend: str = opt("nllb", among=("nllb", "m2m100", "opusmt", "madlad", "teacher", "mock"))
    translate_model: str | None = None
    provider: str = opt("ollama", among=("ollama", "local", "mock"))
    model: str | None = None
    synth: Synth | None = opt(None, of=Synth)
    review: bool = True


@dataclass
class Finetune:
    method: str = opt("qlora", among=TUNING)
    epochs: float = 3.0
    max_steps: int | None = None
    max_seq_len: int = 1024
    learning_rate: float = 2e-4
    dpo: bool = False


@dataclass
class Evaluate:
    benchmarks: list = opt(["native_cloze", "perplexity"])
    limit: int = opt(100, low=1)
    human_review: bool = False
    human_review_n: int = opt(50, low=1)


@dataclass
class Export:
    merge_adapter: bool = True
    quantize: list = opt(["gguf_q4_k_m"])
    push_to_hub: bool = False
    hub_repo: str | None = None
    make_ollama_modelfile: bool = True


@dataclass
class Project:
    name: str
    language: str
    base_model: str
    compute: str
    seed: int = 42
    workdir: str | None = None
    stages: list = opt([])
    ingest: Ingest = opt(Ingest)
    clean: Clean = opt(Clean)
    tokenizer: Tokenizer = opt(Tokenizer)
    pretrain: Pretrain = opt(Pretrain)
    convdata: ConvData = opt(ConvData)
    finetune: Finetune = opt(Finetune)
    evaluate: Evaluate = opt(Evaluate)
    export: Export = opt(Export)

    def __post_init__(self):
        if odd := [s for s in self.stages if s not in STAGES]:
            raise ConfigError(f"Project.stages: unknown {', '.join(odd)}; known: {', '.join(STAGES)}")

    @property
    def selected(self) -> list[str]:
        """Stages to run in canonical order; none named means all."""
        return [s for s in STAGES if not self.stages or s in self.stages]

    @property
    def folder(self) -> str:
        """Where the project's artifacts are: a URI, or a path of this machine."""
        return self.workdir or str(Path.cwd() / "projects" / self.name)

    @property
    def sources(self) -> list[Source]:
        """The language's sources, those named in ingest.sources if any are."""
        chosen = self.ingest.sources
        return [s for s in language(self.language).sources if not chosen or s.connector in chosen]


KINDS: dict[str, tuple[str, type]] = {"language": ("languages", Language), "model": ("models", Model), "compute": ("compute", Compute)}


def roots() -> list[Path]:
    named = [Path(p) for p in os.environ.get("WEFT_CONFIG_PATH", "").split(os.pathsep) if p.strip()]
    return list(dict.fromkeys(p.resolve() for p in [*named, Path.cwd() / "configs"]))


def _made_sources(slug: str, short: str, code: str) -> list[Source]:
    """Where the texts of a bundled language come from, with licences."""
    small = slug == "cornish"
    out = [Source("wikipedia", {"wiki": short, "license": "CC-BY-SA-4.0", "url": f"https://{short}.wikipedia.org"}), Source("glot500", {"glot": code, "license": "mixed"})]
    if not small:
        out.append(Source("culturax", {"lang": short, "license": "ODC-BY-1.0"}))
    out.append(Source("madlad400", {"lang": short, "variant": "clean", "license": "CC-BY-4.0"}))
    if not small:
        out.append(Source("oscar", {"lang": short, "license": "CC0-1.0"}))
    if slug == "welsh":
        out.append(Source("commoncrawl", {"url_pattern": "cy.wikipedia.org/*", "license": "Common-Crawl-ToU"}))
    out.append(Source("opus", {"src": short, "tgt": "en", "corpora": OTHER_CORPORA.get(slug, CORPORA), "license": "mixed"}))
    if small:
        out.append(Source("local", {"path": None, "license": "unknown"}, "texts of your own: set the path"))
    return out


def _made_languages() -> dict[str, dict]:
    out = {}
    for slug, iso3, iso1, script in LANGUAGES:
        code = f"{iso3}_{SCRIPT_TAGS[script]}"
        translated = TRANSLATION_CODES.get(iso3, code)
        native = [NativeSet(INSTRUCTIONS, select_field="language_code", select_value=translated.split("_")[0])] if slug in INSTRUCTED else []
        out[slug] = {
            "display_name": NAMES.get(slug, slug.replace("_", " ").title()),
            "iso639_3": iso3,
            "iso639_1": iso1,
            "nllb_code": translated,
            "scripts": [script],
            "default_script": script,
            "direction": "rtl" if script == "Arabic" else "ltr",
            "family": FAMILIES.get(slug),
            "dialects": DIALECTS.get(slug, []),
            "sources": _made_sources(slug, iso1 or iso3, code),
            "instruction_sources": native,
            "normalization": Normalization(normalize_digits=script == "Arabic", rules=RULES.get(slug, [])),
        }
    return out


def _made_models() -> dict[str, dict]:
    out = {}
    for slug, hub, family, length in MODELS:
        pieces = "sentencepiece" if family in ("gemma", "xlmr") else "bpe"
        out[slug] = {"hf_id": hub, "family": family, "context_length": length, "tokenizer_type": pieces, "arch": "encoder" if family == "xlmr" else "decoder"}
    return out


_MADE = {"language": _made_languages, "model": _made_models, "compute": lambda: COMPUTE}


def _mapping(path: Path) -> dict:
    data = yaml.safe_load(path.read_text(encoding="utf-8")) or {}
    if not isinstance(data, dict):
        raise ConfigError(f"{path}: a mapping is needed")
    return data


def profile(kind: str, slug: str):
    folder, shape = KINDS[kind]
    for root in roots():
        if (path := root / folder / f"{slug}.yaml").is_file():
            return shaped(shape, {"name": slug} | _mapping(path), str(path))
    made = _MADE[kind]()
    if slug not in made:
        raise ProfileNotFound(f"no {kind} {slug!r}; known: {', '.join(slugs(kind))}")
    return shaped(shape, {"name": slug} | made[slug], slug)


def slugs(kind: str) -> list[str]:
    found = {p.stem for r in roots() for p in (r / KINDS[kind][0]).glob("*.yaml")}
    return sorted(found | set(_MADE[kind]()))


def language(slug: str) -> Language:
    return profile("language", slug)


def load_project(path: str | Path) -> Project:
    """The project of a YAML file; the three profiles it names must exist."""
    path = Path(path)
    if not path.is_file():
        raise FileNotFoundError(f"no project file {path}")
    project = shaped(Project, _mapping(path), str(path))
    for kind, slug in (("language", project.language), ("model", project.base_model), ("compute", project.compute)):
        profile(kind, slug)
    return project


def scaffold(language_slug: str, base_model: str = "qwen2.5-1.5b", compute: str = "consumer_gpu") -> str:
    """YAML of a new project with every stage and the settings that are most often changed."""
    blocks = {
        "name": language_slug,
        "language": language_slug,
        "base_model": base_model,
        "compute": compute,
        "stages": list(STAGES),
        "ingest": {"sources": [], "max_gb": 5.0},
        "clean": {"dedup": "minhash", "min_quality": 0.5},
        "convdata": {"provider": "ollama", "review": True},
        "evaluate": {"benchmarks": ["native_cloze", "perplexity"], "limit": 100},
        "export": {"quantize": ["gguf_q4_k_m"]},
    }
    return yaml.safe_dump(blocks, sort_keys=False, allow_unicode=True)
