"""Skill recognition in free text (C5-C8, D10), all JVM-side.

Two modes:

* ``compat``  – one case-insensitive alternation of the term list, every
  match left to right, no word boundaries, list order wins.  This is the
  original rule, quirks included ("javascript" yields "java", "good" yields
  "go").  Output is the matched lowercase text.
* ``bounded`` – longest term first, regex-escaped, with word boundaries on
  both sides; output is the canonical display name.  Used by the warehouse
  load.

Both look for all terms in one pass over the text: the alternation is written
as a trie, so that at each place only terms that begin with the letters met
there are tried, not all 59.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The skill term list, as regex sources, in its original order.
SKILL_PATTERNS = [
    'Python', 'Java', 'JavaScript', 'TypeScript', 'SQL', 'NoSQL', 'MongoDB', 'PostgreSQL',
    'MySQL', 'Spark', 'Hadoop', 'Hive', 'Airflow', 'Docker', 'Kubernetes', 'AWS',
    'Azure', 'GCP', 'Google Cloud', 'Scala', 'Go', 'Rust', 'C\\+\\+', 'C#',
    'React', 'Vue', 'Angular', 'Node.js', 'Django', 'Flask', 'FastAPI', 'Spring',
    'Git', 'Jenkins', 'Elasticsearch', 'Redis', 'Kafka', 'RabbitMQ', 'Tableau',
    'Power BI', 'Looker', 'ETL', 'Linux', 'Unix', 'REST API', 'GraphQL', 'Microservices',
    'Agile', 'Scrum', 'JIRA', 'Pandas', 'NumPy', 'Scikit-learn', 'TensorFlow', 'PyTorch',
    'Machine Learning', 'Deep Learning', 'NLP', 'Computer Vision',
]

# Display name of each term: the regex source without its escapes.
SKILL_NAMES = [p.replace("\\", "") for p in SKILL_PATTERNS]

# Fixed values (ours): a category per skill for dim_skills.skill_category.
SKILL_CATEGORIES = {
    "Language": ["Python", "Java", "JavaScript", "TypeScript", "Scala", "Go", "Rust", "C++", "C#"],
    "Database": ["SQL", "NoSQL", "MongoDB", "PostgreSQL", "MySQL", "Redis", "Elasticsearch"],
    "Data": ["Spark", "Hadoop", "Hive", "Airflow", "Kafka", "ETL", "Tableau", "Power BI",
             "Looker", "Pandas", "NumPy"],
    "DevOps": ["Docker", "Kubernetes", "Jenkins", "Git", "Linux", "Unix"],
    "Cloud": ["AWS", "Azure", "GCP", "Google Cloud"],
    "Frontend": ["React", "Vue", "Angular"],
    "Backend": ["Node.js", "Django", "Flask", "FastAPI", "Spring", "RabbitMQ", "REST API",
                "GraphQL", "Microservices"],
    "AI/ML": ["Scikit-learn", "TensorFlow", "PyTorch", "Machine Learning", "Deep Learning",
              "NLP", "Computer Vision"],
    "Practice": ["Agile", "Scrum", "JIRA"],
}
CATEGORY_OF = {name: cat for cat, names in SKILL_CATEGORIES.items() for name in names}

# Characters that may not touch a bounded match (on lowercased text).
WORD_BEFORE = "a-z0-9_"
WORD_AFTER = "a-z0-9_+#"


_META = set("\\.^$|?*+()[]{}")


def regex_escape(term: str) -> str:
    """Escape regex metacharacters; valid for both Java regex and RE2."""
    return "".join("\\" + ch if ch in _META else ch for ch in term)


def _atoms(pattern: str) -> list[str]:
    """A term's regex source, letter by letter (an escaped sign is one)."""
    out: list[str] = []
    for ch in pattern:
        if out and out[-1] == "\\":
            out[-1] += ch
        else:
            out.append(ch)
    return out


def trie(terms: list[list[str]]) -> str:
    """An alternation of terms (as atoms) with shared beginnings written once.

    Where two terms match at one place the earlier in the list wins, as in the
    plain alternation: terms that go on differently exclude each other, and a
    term that ends keeps its place among those that go on from there.
    """
    tails: dict[str | None, list[list[str]]] = {}
    for term in terms:
        tails.setdefault(term[0] if term else None, []).append(term[1:])
    ways = []
    for atom, rest in tails.items():
        if atom is None:
            ways.append("")
            break  # what comes later never gets its turn here
        ways.append(atom + trie(rest))
    return ways[0] if len(ways) == 1 else "(?:" + "|".join(ways) + ")"


def compat_pattern(patterns: list[str] = SKILL_PATTERNS) -> str:
    """For lowercased text."""
    return "(" + trie([_atoms(p.lower()) for p in patterns]) + ")"


def bounded_pattern(names: list[str] = SKILL_NAMES) -> str:
    """For lowercased text.  Longer terms come first; where a term can't end
    (a word goes on behind it), the shorter ones are tried."""
    terms = sorted({n.lower() for n in names}, key=lambda s: (-len(s), s))
    alt = trie([[regex_escape(c) for c in t] for t in terms])
    return f"(?<![{WORD_BEFORE}])({alt})(?![{WORD_AFTER}])"


def _canonical_map(names: list[str] = SKILL_NAMES) -> Column:
    pairs = []
    for n in names:
        pairs += [F.lit(n.lower()), F.lit(n)]
    return F.create_map(*pairs)


def skills_compat_col(text: Column | str) -> Column:
    """All raw matches (lowercase), left to right; NULL text gives []."""
    text = F.col(text) if isinstance(text, str) else text
    return F.when(text.isNotNull(), F.regexp_extract_all(F.lower(text), F.lit(compat_pattern()), 1)) \
        .otherwise(F.array().cast("array<string>"))


def skills_bounded_col(text: Column | str) -> Column:
    """Distinct canonical skill names found with word boundaries."""
    text = F.col(text) if isinstance(text, str) else text
    canon = _canonical_map()
    found = F.regexp_extract_all(F.lower(text), F.lit(bounded_pattern()), 1)
    return F.coalesce(
        F.array_distinct(F.transform(found, lambda m: canon[m])),
        F.array().cast("array<string>"),
    )


def extract_skills(df: DataFrame, text_col: str = "description_preview", mode: str = "compat",
                   out_col: str = "skill", keep_empty: bool = False) -> DataFrame:
    """One row per recognised skill (C5 + C6).

    ``compat`` keeps repeated matches and drops rows with none, like the
    original; ``keep_empty`` switches to ``explode_outer`` (NULL skill).
    """
    arr = skills_compat_col(text_col) if mode == "compat" else skills_bounded_col(text_col)
    gen = F.explode_outer if keep_empty else F.explode
    return df.withColumn(out_col, gen(arr))


def job_skill_sets(df: DataFrame, text_col: str = "description_preview", mode: str = "compat") -> DataFrame:
    """Sorted distinct skills and their count, per row and where the row is
    (C7, C8): nothing is exploded or shuffled.  A row without a skill, or
    without a text, has an empty list."""
    found = skills_compat_col(text_col) if mode == "compat" else skills_bounded_col(text_col)
    return df.withColumn("skills", F.array_sort(F.array_distinct(found))).withColumn("skill_count", F.size("skills"))
