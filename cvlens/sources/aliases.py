"""Skill alias dictionary (S7): JSON file -> (alias, canonical) DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The shipped alias dictionary, alias -> canonical name, in file order.
DEFAULT_ALIASES: dict[str, str] = {
    "js": "JavaScript", "javascript": "JavaScript", "react.js": "React", "reactjs": "React",
    "react js": "React", "vue.js": "Vue.js", "vuejs": "Vue.js", "node.js": "Node.js",
    "nodejs": "Node.js", "node js": "Node.js", "ml": "Machine Learning",
    "machine-learning": "Machine Learning", "ai": "Artificial Intelligence",
    "artificial-intelligence": "Artificial Intelligence", "dl": "Deep Learning",
    "deep-learning": "Deep Learning", "nlp": "Natural Language Processing",
    "natural-language-processing": "Natural Language Processing", "cv": "Computer Vision",
    "computer-vision": "Computer Vision", "py": "Python", "python3": "Python", "sql": "SQL",
    "mysql": "MySQL", "postgresql": "PostgreSQL", "postgres": "PostgreSQL", "mongodb": "MongoDB",
    "mongo": "MongoDB", "aws": "Amazon Web Services", "amazon-web-services": "Amazon Web Services",
    "gcp": "Google Cloud Platform", "google-cloud": "Google Cloud Platform", "azure": "Microsoft Azure",
    "k8s": "Kubernetes", "docker": "Docker", "ci/cd": "CI/CD", "cicd": "CI/CD", "rest": "REST API",
    "restful": "REST API", "rest-api": "REST API", "graphql": "GraphQL", "html5": "HTML",
    "css3": "CSS", "typescript": "TypeScript", "ts": "TypeScript", "c++": "C++", "cpp": "C++",
    "c#": "C#", "csharp": "C#", "dotnet": ".NET", ".net": ".NET", "java": "Java", "golang": "Go",
    "go": "Go", "ruby": "Ruby", "rails": "Ruby on Rails", "ruby-on-rails": "Ruby on Rails",
    "php": "PHP", "swift": "Swift", "kotlin": "Kotlin", "scala": "Scala", "r": "R",
    "matlab": "MATLAB", "excel": "Microsoft Excel", "ms-excel": "Microsoft Excel",
    "powerpoint": "Microsoft PowerPoint", "ms-powerpoint": "Microsoft PowerPoint",
    "word": "Microsoft Word", "ms-word": "Microsoft Word", "git": "Git", "github": "GitHub",
    "gitlab": "GitLab", "bitbucket": "Bitbucket", "jira": "Jira", "confluence": "Confluence",
    "agile": "Agile", "scrum": "Scrum", "kanban": "Kanban", "tensorflow": "TensorFlow",
    "tf": "TensorFlow", "pytorch": "PyTorch", "keras": "Keras", "scikit-learn": "scikit-learn",
    "sklearn": "scikit-learn", "pandas": "Pandas", "numpy": "NumPy", "matplotlib": "Matplotlib",
    "seaborn": "Seaborn", "tableau": "Tableau", "power-bi": "Power BI", "powerbi": "Power BI",
    "excel-vba": "Excel VBA", "vba": "VBA", "sap": "SAP", "salesforce": "Salesforce", "crm": "CRM",
    "erp": "ERP", "hadoop": "Hadoop", "spark": "Apache Spark", "apache-spark": "Apache Spark",
    "kafka": "Apache Kafka", "apache-kafka": "Apache Kafka", "redis": "Redis",
    "elasticsearch": "Elasticsearch", "elastic-search": "Elasticsearch", "jenkins": "Jenkins",
    "ansible": "Ansible", "terraform": "Terraform", "linux": "Linux", "unix": "Unix", "bash": "Bash",
    "shell": "Shell Scripting", "shell-scripting": "Shell Scripting", "powershell": "PowerShell",
}

ALIAS_SCHEMA = "alias string, canonical string"


def alias_frame(spark: SparkSession, aliases: dict[str, str] | None = None) -> DataFrame:
    """A small in-memory dictionary as a DataFrame (keys kept as written)."""
    aliases = DEFAULT_ALIASES if aliases is None else aliases
    return spark.createDataFrame(list(aliases.items()), ALIAS_SCHEMA)


def _entries(values: DataFrame) -> DataFrame:
    """(alias, canonical) of JSON objects in ``value``; the nested key wins, values that are no strings are dropped."""
    whole = values.select(F.parse_json("value").alias("v"))
    inner = whole.select(F.coalesce(F.try_variant_get("v", "$.aliases", "variant"), F.col("v")).alias("v"))
    # a map of variants keeps each value's own type
    entries = inner.select(F.explode(F.try_variant_get("v", "$", "map<string,variant>")).alias("alias", "value"))
    return (entries.where(F.schema_of_variant("value") == "STRING")
            .select("alias", F.variant_get("value", "$", "string").alias("canonical")))


def _is_missing(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def load_alias_dictionary(spark: SparkSession, path: str, missing_ok: bool = False) -> DataFrame:
    """Read ``{"aliases": {...}}`` or a flat ``{...}`` JSON object.

    The nested key wins when present. Values that are no strings are dropped;
    malformed JSON is an error. A missing file is an error too, or an empty
    dictionary with ``missing_ok`` (a processor without its file). One document
    is one row: a dictionary of many entries belongs in lines.
    """
    if missing_ok and _is_missing(spark, path):
        return spark.createDataFrame([], ALIAS_SCHEMA)
    return _entries(spark.read.text(path, wholetext=True))


def load_alias_lines(spark: SparkSession, path: str, missing_ok: bool = False) -> DataFrame:
    """Read a dictionary of any size: files of lines, each a JSON object of either form.

    Lines are merged by key; of the names of one key the smallest in code-point
    order wins, whatever the order of lines and files. Blank lines are skipped,
    malformed ones are an error.
    """
    if missing_ok and _is_missing(spark, path):
        return spark.createDataFrame([], ALIAS_SCHEMA)
    lines = spark.read.text(path).where(F.trim("value") != "")
    return _entries(lines).groupBy("alias").agg(F.min("canonical").alias("canonical"))


def write_alias_lines(aliases: DataFrame, path: str) -> None:
    """(alias, canonical) as lines, one object each."""
    aliases.select(F.to_json(F.create_map("alias", "canonical")).alias("value")).write.mode("overwrite").text(path)


def part_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dictionary for the driver tables, built by rule from ``part``.

    * ``lower(p_type) -> initcap(p_type)`` (exact matches);
    * ``p_name without spaces -> p_name with a capital first letter``: the
      spaced, lower-case name is not a key, so it reaches the fuzzy step
      (``red bolt`` vs ``Red bolt`` scores 87.5).
    Unioned with the shipped dictionary.
    """
    from cvlens.sources.tables import table
    part = table(spark, sf_dir, "part")
    types = part.select(F.lower("p_type").alias("alias"), F.initcap("p_type").alias("canonical"))
    names = part.select(F.regexp_replace("p_name", " ", "").alias("alias"),
                        F.concat(F.upper(F.substring("p_name", 1, 1)), F.expr("substring(p_name, 2)"))
                        .alias("canonical"))
    return alias_frame(spark).unionByName(types).unionByName(names).distinct()


def part_aliases_sql() -> str:
    shipped = ", ".join("('%s', '%s')" % (k.replace("'", "''"), v.replace("'", "''"))
                        for k, v in DEFAULT_ALIASES.items())
    return f"""(SELECT DISTINCT alias, canonical FROM (
      SELECT * FROM (VALUES {shipped}) v(alias, canonical)
      UNION ALL SELECT lower(p_type), upper(p_type[1]) || lower(p_type[2:]) FROM part
      UNION ALL SELECT replace(p_name, ' ', ''), upper(p_name[1]) || p_name[2:] FROM part))"""
