"""Names, slugs, IRIs and URLs as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Aliases of the evaluation tasks, and the units of metrics.
TASK_ALIASES = {
    "thermodynamic_stability_classification_task": (
        "thermodynamic_stability_classification_task",
        "thermodynamic_stability_classification",
        "stable_unstable_material_classification",
        "stable_unstable_classification",
        "stability_classification",
        "classifying_thermodynamic_stability",
        "classify_thermodynamic_stability",
        "discovery",
        "discovery_screening",
    ),
    "convex_hull_distance_regression_task": (
        "convex_hull_distance_regression_task",
        "convex_hull_distance_regression",
        "convex_hull_distance",
        "hull_distance_regression",
        "mae_of_predicted_vs_dft_convex_hull_distance",
    ),
    "phonon_thermal_conductivity_contribution_task": (
        "phonon_thermal_conductivity_contribution_task",
        "phonon_thermal_conductivity_contribution",
        "phonon_mode_contributions_to_thermal_conductivity",
        "phonons",
    ),
    "relaxed_structure_matching_rmsd_task": (
        "relaxed_structure_matching_rmsd_task",
        "relaxed_structure_matching_rmsd",
        "structurematcher_rmsd",
        "structure_matching_rmsd",
        "geo_opt",
        "geometry_optimization",
    ),
}
METRIC_UNITS = {
    "eV/atom": ("mae", "rmse"),
    "count": ("tp", "fp", "tn", "fn", "missing_preds", "n_structures"),
    "fraction": ("f1", "precision", "recall", "accuracy", "tpr", "fpr", "tnr", "fnr", "symmetry_decrease", "symmetry_match", "symmetry_increase"),
}


def _underscored(text: Column, keep: str = "a-z0-9") -> Column:
    return F.btrim(F.regexp_replace(text, f"[^{keep}]+", "_"), F.lit("_"))


def _trimmed(value: Column) -> Column:
    return F.regexp_replace(value.cast("string"), r"(?U)^\s+|\s+$", "")


def slug(value: Column) -> Column:
    """Main form: kappa and angstrom spelled out; null and nothing left are ``unknown``."""
    text = F.lower(_trimmed(value))
    for sign, word in (("κ", "kappa"), ("îº", "kappa"), ("Îº", "kappa"), ("å", "angstrom"), ("Å", "angstrom")):
        text = F.replace(text, F.lit(sign), F.lit(word))
    return F.coalesce(F.nullif(_underscored(text), F.lit("")), F.lit("unknown"))


def slug_plain(value: Column) -> Column:
    """Scraper form: no Greek, may be empty."""
    return _underscored(F.lower(_trimmed(value)))


def slug_extracted(value: Column) -> Column:
    """Extractor form: kappa spelled out only; may be empty."""
    return _underscored(F.replace(F.lower(_trimmed(value)), F.lit("κ"), F.lit("kappa")))


def slug_site(value: Column) -> Column:
    """Site form: letters and digits of all scripts stay; nothing left is ``unnamed``."""
    text = F.replace(F.lower(_trimmed(value)), F.lit("ω"), F.lit("omega"))
    return F.coalesce(F.nullif(_underscored(text, r"\p{L}\p{N}"), F.lit("")), F.lit("unnamed"))


def canonical_key(value: Column) -> Column:
    """Slug with hyphens."""
    return F.btrim(F.regexp_replace(F.lower(_trimmed(value)), "[^a-z0-9]+", "-"), F.lit("-"))


def local_name(value: Column) -> Column:
    """What follows the last colon."""
    return F.substring_index(value.cast("string"), ":", -1)


def class_or_default(namespace: str, name: Column, default: str) -> Column:
    """IRI of a class named in a namespace, whether or not it exists."""
    named = F.nullif(_trimmed(local_name(name)), F.lit(""))
    return F.concat(F.lit(namespace), F.coalesce(named, F.lit(default)))


def dataset_class_or_default(data: str, train: str, name: Column, default: str = "Dataset") -> Column:
    """As :func:`class_or_default`; a training dataset is in the training namespace."""
    named = F.coalesce(F.nullif(_trimmed(local_name(name)), F.lit("")), F.lit(default))
    return F.concat(F.when(named == "TrainingDataset", F.lit(train)).otherwise(F.lit(data)), named)


def scoped_id(*parts: Column) -> Column:
    """Slugs of the parts that are not null or empty, joined by underscores."""
    return F.concat_ws("_", *[F.when(F.coalesce(p.cast("string"), F.lit("")) != "", slug(p)) for p in parts])


def scoped_resource(scope: Column, name: Column, suffix: str) -> Column:
    """Name prefixed by its scope and ended by a suffix, unless it already is."""
    s, n = slug(scope), slug(name)
    scoped = F.when((n == s) | F.startswith(n, F.concat(s, F.lit("_"))), n).otherwise(F.concat(s, F.lit("_"), n))
    return F.when(F.endswith(scoped, F.lit("_" + suffix)), scoped).otherwise(F.concat(scoped, F.lit("_" + suffix)))


def metric_unit(name: Column) -> Column:
    text = slug(name)
    out = F.lit("dimensionless")
    for unit, names in reversed(METRIC_UNITS.items()):
        out = F.when(text.isin(*names), F.lit(unit)).otherwise(out)
    return out


def canonical_task(name: Column) -> Column:
    """The canonical task of an alias; the slug of any other name."""
    text = slug(name)
    out = text
    for task, aliases in TASK_ALIASES.items():
        out = F.when(text.isin(*aliases), F.lit(task)).otherwise(out)
    return out


def collapsed(value: Column) -> Column:
    """White space runs as one space, none at the ends; null is empty."""
    return F.regexp_replace(F.regexp_replace(F.coalesce(value, F.lit("")), r"(?U)\s+", " "), r"^ | $", "")


def header_text(value: Column) -> Column:
    """A table header without its sorting arrows."""
    return collapsed(F.regexp_replace(F.coalesce(value, F.lit("")), "[↑↓▲▼]", ""))


def cell_number(sort_value: Column, text: Column) -> Column:
    """Whole number of a table cell; null where there is none."""
    raw = F.lower(F.trim(F.coalesce(sort_value, text)))
    return F.when(~raw.isin("", "n/a"), raw.try_cast("double").cast("long"))


def cell_bool(style: Column) -> Column:
    """Truth of a table cell by its colour."""
    return F.when(style.contains("lightgreen"), True).when(style.contains("lightcoral"), False)


def parse_created(title: Column, text: Column) -> Column:
    """ISO date of the first candidate that is one, after its first comma if it has one; else the raw text."""

    def one(raw: Column) -> Column:
        part = F.trim(F.when(raw.contains(","), F.substring(raw, F.instr(raw, ",") + 1, F.length(raw))).otherwise(raw))
        return F.coalesce(F.try_to_date(part, "MMM d, yyyy"), F.try_to_date(part, "yyyy-MM-dd")).cast("string")

    return F.coalesce(one(title), one(text), F.nullif(F.trim(title), F.lit("")), F.trim(text))


def paper_url(url: Column) -> Column:
    """The PDF of a preprint's abstract or HTML page; other URLs as they are."""
    last = F.substring_index(F.regexp_replace(url, "/+$", ""), "/", -1)
    return (
        F.when(F.coalesce(url, F.lit("")) == "", F.lit(None).cast("string"))
        .when(url.contains("arxiv.org/abs/"), F.concat(F.replace(url, F.lit("/abs/"), F.lit("/pdf/")), F.lit(".pdf")))
        .when(url.contains("arxiv.org/html/"), F.concat(F.lit("https://arxiv.org/pdf/"), last, F.lit(".pdf")))
        .otherwise(url)
    )


def model_selector(value: Column) -> Column:
    """Model slug of a file name, page URL or plain name."""
    text = F.trim(value)
    name = F.regexp_replace(text, "^.*/", "")
    stem = F.when(text.rlike(r"\.(ya?ml|pdf|json|ttl)$"), F.regexp_replace(name, r"\.[^.]*$", "")).otherwise(text)
    stem = F.regexp_replace(stem, "_model_extraction$", "")
    stem = F.regexp_replace(F.regexp_replace(stem, "_model_individuals_generated$", ""), "_individuals_generated$", "")
    last = F.substring_index(F.regexp_replace(stem, "/+$", ""), "/", -1)
    return F.when(F.coalesce(value, F.lit("")) != "", slug_plain(F.when(stem.contains("/models/"), last).otherwise(stem)))


def contents_api_url(url: Column) -> Column:
    """The contents interface of a repository folder's page; a hyphen for a branch is main; null for other pages."""
    shape = r"github\.com/([^/]+)/([^/]+)/(?:tree|blob)/([^/]+)/?(.*)$"
    part = lambda i: F.regexp_extract(url, shape, i)
    branch = F.when(part(3) == "-", F.lit("main")).otherwise(part(3))
    whole = F.concat(F.lit("https://api.github.com/repos/"), part(1), F.lit("/"), part(2), F.lit("/contents/"), part(4), F.lit("?ref="), branch)
    return F.when(url.rlike(shape), whole)


def files_route(url: Column) -> Column:
    """How the files behind a URL are found: ``file``, ``api`` or ``page``."""
    return F.when(url.rlike(r"\.ya?ml$"), "file").when(url.contains("github.com"), F.when(contents_api_url(url).isNotNull(), "api")).otherwise("page")


def without_base_folder(text: Column, folder: Column) -> Column:
    """Backslashes as slashes, and paths relative to a folder."""
    unix = F.replace(text, F.lit("\\"), F.lit("/"))
    return F.replace(unix, F.concat(F.regexp_replace(F.replace(folder, F.lit("\\"), F.lit("/")), "/+$", ""), F.lit("/")), F.lit(""))
