"""Descriptions of the sources that records are extracted from."""

from __future__ import annotations

from dataclasses import dataclass

# How a source holds its text; see snipmill.operators.extract.
FIELDS = "fields"
TAGGED_SOLUTIONS = "tagged solutions"
SOLUTION_LISTS = "solution lists"


@dataclass(frozen=True)
class Source:
    """One dataset and the way to get a snippet out of each of its rows."""

    id: str
    hf_name: str
    language: str
    split: str
    content_fields: tuple[str, ...]
    separator: str | None = None
    max_samples: int | None = None
    subset: str | None = None
    shape: str = FIELDS
    solutions_field: str = "solutions"
    language_key: str = "language"
    code_key: str = "solution"
    # "first" keeps the first field with text, "concat" joins all of them.
    combine: str = "first"
    stream: bool = False
    format: str = "parquet"
    # DDL of a JSON source, which unlike Parquet does not carry its schema.
    schema: str | None = None

    @property
    def streamed(self) -> bool:
        """Only Python sources may be read as a stream."""
        return self.stream and self.language == "python"

    def path(self, root: str) -> str:
        """Where the source lies: root / name / [subset /] split."""
        return "/".join(filter(None, (root.rstrip("/"), self.hf_name, self.subset, self.split)))


# Names, fields, separators and caps of the known sources.
SOURCES = (
    Source(
        "mbpp_py", "mbpp", "python", "train",
        ("text", "code"), "\n\n# Solution:\n", 10000,
    ),
    Source(
        "humaneval_py", "openai_humaneval", "python", "test",
        ("prompt", "canonical_solution"), "\n", 2000,
    ),
    Source(
        "apps_py", "codeparrot/apps", "python", "train",
        ("problem", "solutions"), "\n\n# Solutions:\n", 50,
        shape=SOLUTION_LISTS,
    ),
    Source(
        "codeforces_py", "MatrixStudio/Codeforces-Python-Submissions", "python", "train",
        ("code",), None, 50000,
    ),
    Source(
        "alpaca_py_instr", "iamtarun/python_code_instructions_18k_alpaca", "python", "train",
        ("instruction", "output"), "\n\n# Output:\n", 18000,
    ),
    Source(
        "cpp_code_contests", "deepmind/code_contests", "cpp", "train",
        ("description",), "\n\n// Solution:\n", 10000,
        shape=TAGGED_SOLUTIONS,
    ),
    Source(
        "java_code_contests", "deepmind/code_contests", "java", "train",
        ("description",), "\n\n// Solution:\n", 10000,
        shape=TAGGED_SOLUTIONS,
    ),
    Source(
        "rust_code_snippets_new", "RustHint/Rust_Code_Snippets", "rust", "train",
        ("Snippet",), None, 5000,
    ),
    Source(
        "c_code_snippets_new", "nampdn-ai/C-Code-Snippets", "c", "train",
        ("Text",), None, 10000,
    ),
)


def plain_corpus(id: str, language: str, max_samples: int | None = None) -> Source:
    """Source in the plain corpus form: one JSON object with a text per line."""
    return Source(
        id, id, language, "train", ("text",), max_samples=max_samples,
        format="json", schema="text string",
    )
