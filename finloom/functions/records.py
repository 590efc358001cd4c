"""Reshaping of single records: sparse maps, flattened structs, typed blocks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def sparse_map(fields: Mapping[str, Column]) -> Column:
    """Map of the fields that are neither null nor blank."""
    pairs = [x for k, v in fields.items() for x in (F.lit(k), v.cast("string"))]
    return F.map_filter(F.create_map(*pairs), lambda _, v: F.coalesce(F.trim(v) != "", F.lit(False)))


def flattened(df: DataFrame, separator: str = ".") -> DataFrame:
    """Structs, however deep, as columns with dotted names."""

    def walk(schema: StructType, path: tuple[str, ...]) -> list[Column]:
        out: list[Column] = []
        for f in schema.fields:
            here = (*path, f.name)
            if isinstance(f.dataType, StructType):
                out += walk(f.dataType, here)
            else:
                out.append(F.col(".".join(f"`{p}`" for p in here)).alias(separator.join(here)))
        return out

    return df.select(*walk(df.schema, ()))


def previews(answers: Column, most: int = 100) -> Column:
    """Map ``chat_answer_<i>_preview`` to the start of each answer that isn't blank."""
    indexed = F.transform(answers, lambda x, i: F.struct(F.concat(F.lit("chat_answer_"), i.cast("string"), F.lit("_preview")).alias("k"), F.left(x, F.lit(most)).alias("v")))
    return F.map_from_entries(F.filter(indexed, lambda e: F.coalesce(F.trim(e["v"]) != "", F.lit(False))))


def dependencies(body: Column, kind: str) -> Column:
    """Numbers after ``kind: #n`` or ``kind #n`` in a text, in order."""
    found = F.regexp_extract_all(body, F.lit(rf"(?i)\b{kind}:?\s*#(\d+)"), F.lit(1))
    return F.transform(found, lambda x: x.cast("int"))


def spreadsheet_key(text: Column) -> Column:
    """The key in a spreadsheet's URL, or the text itself."""
    key = F.regexp_extract(text, r"/spreadsheets/d/([A-Za-z0-9_-]+)", 1)
    return F.when(F.length(key) > 0, key).otherwise(text)


def valid_ticker(text: Column, most: int = 10) -> Column:
    """Trimmed upper case of what may be a ticker, else null."""
    plain = F.upper(F.trim(text))
    return F.when(plain.rlike(rf"^\^?[A-Z0-9][A-Z0-9.=-]*$") & (F.length(plain) <= most), plain)


def best_status(statuses: Column) -> Column:
    """done if all are, pending if none has begun, else in_progress; pending for none."""
    return (
        F.when(F.size(statuses) == 0, "pending")
        .when(F.forall(statuses, lambda s: s == "done"), "done")
        .when(F.exists(statuses, lambda s: s.isin("done", "in_progress")), "in_progress")
        .otherwise("pending")
    )


def prefix_category(name: Column, rules: Sequence[tuple[str, str]], default: str = "General") -> Column:
    """Category of the first prefix that fits."""
    out = F.lit(default)
    for prefix, category in reversed(rules):
        out = F.when(F.startswith(name, F.lit(prefix)), category).otherwise(out)
    return out


def blocks(body: Column) -> Column:
    """Lines that aren't blank as (kind, content): heading, list, quote,
    separator, image, table or paragraph."""
    lines = F.filter(F.transform(F.split(body, "\n"), lambda x: F.rtrim(x)), lambda x: F.trim(x) != "")

    def kind(x: Column) -> Column:
        return (
            F.when(x.rlike(r"^#{1,6}\s"), "heading")
            .when(x.rlike(r"^\s*(-{3,}|\*{3,}|_{3,})$"), "separator")
            .when(x.rlike(r"^\s*([-*+]|\d+\.)\s"), "list")
            .when(x.rlike(r"^>"), "quote")
            .when(x.rlike(r"^!\[[^\]]*\]\([^)]*\)$"), "image")
            .when(x.rlike(r"^\|.*\|$"), "table")
            .otherwise("paragraph")
        )

    return F.transform(lines, lambda x: F.struct(kind(x).alias("kind"), F.trim(F.regexp_replace(x, r"^(#{1,6}|>|\s*([-*+]|\d+\.))\s+", "")).alias("content")))


def right_aligned(cells: Column) -> Column:
    """Whether half of a column's cells or more look like numbers."""
    filled = F.filter(cells, lambda c: F.coalesce(F.trim(c) != "", F.lit(False)))
    numeric = F.filter(filled, lambda c: F.trim(c).rlike(r"^[+-]?[$¥€]?[\d,]+(\.\d+)?%?$"))
    return (F.size(filled) > 0) & (2 * F.size(numeric) >= F.size(filled))


def phase_status(parts: Column) -> Column:
    """Status of a phase by the statuses of its parts (a map): done if all are,
    in_progress if one is done, else pending; parts without a status don't count."""
    values = F.filter(F.map_values(parts), lambda v: v.isNotNull())
    return (
        F.when(F.coalesce(F.size(values), F.lit(0)) <= 0, "pending")
        .when(F.forall(values, lambda v: v == "done"), "done")
        .when(F.exists(values, lambda v: v == "done"), "in_progress")
        .otherwise("pending")
    )


def simple_workflow(workflow: Column, phases: Mapping[str, Sequence[str]]) -> Column:
    """Map of each new phase to the best status of the old ones that it stands
    for; old phases that are missing don't count."""
    pairs = []
    for phase, keys in phases.items():
        held = F.array_compact(F.array(*[F.try_element_at(workflow, F.lit(k)) for k in keys]))
        pairs += [F.lit(phase), F.when(workflow.isNull(), "pending").otherwise(best_status(held))]
    return F.create_map(*pairs)


# Phases of articles and the older ones that they took the place of.
WORKFLOW_PHASES = {
    "research": ("data_collection", "processing", "research"),
    "draft": ("writing", "draft"),
    "critique": ("critique",),
    "revision": ("revision",),
    "publish": ("publishing", "publish"),
}


def article_meta(old: DataFrame, content: str, category: str, path: str, now: Column) -> DataFrame:
    """Metadata of articles in the new form from the JSON of the old one; what is
    missing takes its default, and a document that is no JSON gives all of them."""
    o = F.from_json(
        content,
        "topic string, title string, status string, created_at string, updated_at string, tags array<string>, target_audience string, symbols array<string>, "
        "theme string, article_id string, pattern_id string, workflow map<string,string>",
    )
    filled = lambda *c: F.coalesce(*[F.nullif(x, F.lit("")) for x in c])
    none = F.array().cast("array<string>")
    return old.select(
        F.coalesce(filled(o["topic"]), o["title"], F.lit("")).alias("title"), F.col(category).alias("category"), F.coalesce(o["status"], F.lit("research")).alias("status"),
        F.coalesce(o["created_at"], now).alias("created_at"), F.coalesce(o["updated_at"], now).alias("updated_at"), F.coalesce(o["tags"], none).alias("tags"),
        F.coalesce(o["target_audience"], F.lit("intermediate")).alias("target_audience"), F.coalesce(o["symbols"], none).alias("symbols"), F.coalesce(o["theme"], F.lit("")).alias("theme"),
        simple_workflow(o["workflow"], WORKFLOW_PHASES).alias("workflow"),
        F.struct(F.col(path).alias("old_path"), filled(o["article_id"], o["pattern_id"]).alias("old_article_id"), now.alias("migrated_at")).alias("legacy"),
    )


def bold_cell(value: Column) -> Column:
    """text and bold of a table's cell: a cell that is one ``**text**`` is bold."""
    inner = F.regexp_extract(F.trim(value), r"(?s)\A\*\*(.+?)\*\*\z", 1)
    return F.struct(F.when(inner != "", inner).otherwise(value).alias("text"), (inner != "").alias("bold"))


def project_tasks(files: DataFrame, key: str, content: str) -> DataFrame:
    """Tasks (``#### [word] 1.2: title``) of project files with their issue,
    priority (medium), status (todo) and depends_on, one row each."""
    task = r"\A####\s+(?:\S+\s+)?(\d+\.\d+):\s*([^\n]+)"
    parts = files.select(key, F.posexplode(F.split(content, r"(?=####\s+)")).alias("at", "part")).where(F.col("part").rlike(task))
    found = lambda pattern, i=1: F.nullif(F.regexp_extract("part", pattern, i), F.lit(""))
    return parts.select(
        key, "at", found(task).alias("task"), F.trim(found(task, 2)).alias("title"), found(r"Issue:\s*\[#(\d+)\]").cast("int").alias("issue"),
        F.lower(F.coalesce(found(r"(?i)priority:\s*(high|medium|low)"), F.lit("medium"))).alias("priority"),
        F.lower(F.coalesce(found(r"(?i)status:\s*(todo|in_progress|done)"), F.lit("todo"))).alias("status"),
        F.transform(F.regexp_extract_all("part", F.lit(r"depends_on:\s*\[#(\d+)\]"), F.lit(1)), lambda x: x.cast("int")).alias("depends_on"),
    )


def padded_table(df: DataFrame, widths: Mapping[str, int]) -> DataFrame:
    """Rows as lines of text: every column cut or padded to its width."""
    return df.select(F.rtrim(F.concat_ws("  ", *[F.rpad(F.coalesce(F.col(c).cast("string"), F.lit("")), w, " ") for c, w in widths.items()])).alias("line"))
