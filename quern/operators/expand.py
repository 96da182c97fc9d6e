"""Corpus expansion: trees, tasks, variants, templates and quotas."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.text import bullet_list, fill_template, hash_number, pick
from quern.operators.convert import numbered
from quern.scratch import small, stored

# Variant types, in order of their ids.
VARIANT_TYPES = [
    "Color Scheme", "Layout Style", "Interaction Mode", "Responsive Design", "Animation Effects", "Accessibility Features",
    "Advanced Features", "Minimalist Design", "Data Visualization", "Real-time Updates", "Gamification", "Internationalization",
]

# Category, name and weight; keys of the technologies.
CATEGORY_WEIGHTS = [
    ("Classic Games", 0.12), ("Action Games", 0.06), ("Puzzle Games", 0.04), ("Strategy & Card Games", 0.04),
    ("CRUD & Management Systems", 0.12), ("Business Applications", 0.10), ("Data Charts", 0.06), ("Dashboards & Analytics", 0.03),
    ("Maps & Geospatial", 0.02), ("SVG & Graphics", 0.08), ("Calculators & Converters", 0.06), ("Media Processing Tools", 0.06),
    ("Physics Simulations", 0.05), ("Animation & Visual Effects", 0.04), ("Messaging & Communication", 0.03), ("E-commerce & Shopping", 0.02),
]
TECHNOLOGIES = ["canvas", "vanilla", "svg", "threejs", "react", "echarts"]

# The pools that template variables are filled from.
COLOURS = [
    "light theme", "dark theme", "high contrast", "low contrast", "warm tones", "cool tones", "earth tones", "pastel palette",
    "neon palette", "natural tones", "ocean-inspired", "sunset-inspired", "corporate blue and gray", "tech-inspired cyan",
    "eco green", "gradient-based palette", "glassmorphism colors", "duotone scheme",
]
LAYOUTS = [
    "single column", "two column", "three column", "multi-column", "sidebar layout", "split screen", "full-width", "boxed layout",
    "grid layout", "masonry layout", "card layout", "list layout", "F-pattern layout", "Z-pattern layout", "modular layout",
    "sticky header", "hero section layout",
]
STYLES = [
    "minimalist", "modern", "clean", "elegant", "sleek", "refined", "streamlined", "polished", "professional", "balanced",
    "creative", "artistic", "expressive", "experimental", "playful", "innovative", "aesthetic", "bold", "dynamic", "trend-driven",
    "corporate", "luxury", "premium", "trustworthy", "formal", "approachable", "friendly", "casual", "youthful", "vibrant",
    "modern Asian", "Nordic", "Japanese simplicity", "European classic", "urban contemporary", "nature-inspired", "organic",
    "warm", "neutral", "calming", "Bootstrap style", "Tailwind style", "Ant Design style", "Material UI style",
]
FEATURES = [
    "responsive", "mobile-first", "adaptive layout", "fluid design", "animated", "interactive", "hover effects",
    "smooth transitions", "parallax scrolling", "scroll animations", "micro-interactions", "accessible", "ARIA compliant",
    "semantic HTML", "keyboard navigable", "lazy loaded", "optimized images", "progressive loading", "skeleton UI",
    "CSS Grid layout", "Flexbox layout", "CSS variables", "dark mode toggle", "SVG icons", "web fonts",
]
POOLS = {"color_scheme": COLOURS, "design_style": STYLES, "features": FEATURES, "layout_type": LAYOUTS}


def leaf_paths(nodes: DataFrame, most_levels: int = 32) -> DataFrame:
    """(node_id, root, path) of every node without children, from (node_id, parent_id, name, is_leaf).

    path lists the names from the root's child down. One join a level; levels end when no child is left.
    """
    parents = nodes.where("parent_id IS NOT NULL").select(F.col("parent_id").alias("node_id")).distinct()
    level = nodes.where("parent_id IS NULL").select("node_id", F.lit(None).cast("string").alias("root"), F.array().cast("array<string>").alias("path"), "is_leaf")
    found = None
    for _ in range(most_levels):
        ends = level.join(parents.withColumn("inner", F.lit(True)), "node_id", "left").where("is_leaf OR inner IS NULL").select("node_id", "root", "path")
        found = ends if found is None else found.union(ends)
        children = nodes.select(F.col("node_id").alias("child"), F.col("parent_id").alias("node_id"), "name", F.col("is_leaf").alias("child_is_leaf"))
        level = stored(
            level.where("NOT is_leaf").join(children, "node_id")
            .select(F.col("child").alias("node_id"), F.coalesce("root", "name").alias("root"), F.concat("path", F.array("name")).alias("path"), F.col("child_is_leaf").alias("is_leaf"))
        )
        if level.isEmpty():
            return found
    raise ValueError(f"the tree has more than {most_levels} levels, or a cycle")


def tree_stats(nodes: DataFrame) -> DataFrame:
    """(total_nodes, leaf_count, max_depth, avg_branching_factor), leaves being nodes without children."""
    children = nodes.where("parent_id IS NOT NULL").groupBy(F.col("parent_id").alias("node_id")).agg(F.count("*").alias("n"))
    joined = nodes.join(children, "node_id", "left").select("depth", F.coalesce("n", F.lit(0)).alias("n"))
    return joined.agg(F.count("*").alias("total_nodes"), F.count_if(F.col("n") == 0).alias("leaf_count"), F.max("depth").cast("long").alias("max_depth"), F.round(F.avg("n"), 3).alias("avg_branching_factor"))


def depth_counts(nodes: DataFrame) -> DataFrame:
    return nodes.groupBy(F.col("depth").cast("long").alias("depth")).agg(F.count("*").alias("n"))


def grow(nodes: DataFrame, fetch: Callable[[DataFrame], DataFrame], max_depth: int) -> DataFrame:
    """Expand a tree in waves: fetch gets the pending nodes and returns (parent_id, name, node_id) of their children.

    Pending are nodes below the root, above max_depth, no leaf, without children and not asked for before. A node for
    which fetch returns nothing becomes a leaf of this run; it isn't recorded as done.
    """
    tried = None
    while True:
        parents = nodes.where("parent_id IS NOT NULL").select(F.col("parent_id").alias("node_id")).distinct()
        pending = nodes.where(f"depth >= 1 AND depth < {max_depth} AND NOT is_leaf").join(parents, "node_id", "left_anti")
        pending = stored(pending if tried is None else pending.join(tried, "node_id", "left_anti"))
        if pending.isEmpty():
            return nodes
        asked = pending.select("node_id")
        tried = asked if tried is None else stored(tried.union(asked))
        new = fetch(pending).join(pending.select(F.col("node_id").alias("parent_id"), F.col("depth").alias("above")), "parent_id")
        nodes = stored(nodes.unionByName(new.select("node_id", "parent_id", "name", (F.col("above") + 1).alias("depth"), F.lit(False).alias("is_leaf")), allowMissingColumns=True))


def expand_tasks(subcategories: DataFrame, per: int = 10) -> DataFrame:
    """One row for each of the first `per` tasks; subcategories with fewer are left out. task_id = subcat_id * per + i."""
    rows = subcategories.where(F.size("tasks") >= per).select(*[c for c in subcategories.columns if c != "tasks"], F.posexplode(F.slice("tasks", 1, per)).alias("i", "specific_task"))
    return rows.withColumn("task_id", F.col("subcat_id") * per + F.col("i")).drop("i")


def expand_variants(tasks: DataFrame, types: list[str] = VARIANT_TYPES) -> DataFrame:
    """Every task with every variant type. variant_id = task_id * number of types + type - 1."""
    kinds = F.array(*[F.struct(F.lit(i + 1).cast("long").alias("variant_type_id"), F.lit(t).alias("variant_type")) for i, t in enumerate(types)])
    return tasks.select("*", F.inline(kinds)).withColumn("variant_id", F.col("task_id") * len(types) + F.col("variant_type_id") - 1)


def fill_prompts(leaves: DataFrame, templates: DataFrame, per_leaf: int = 100, seed: int = 42, key: str = "node_id") -> DataFrame:
    """per_leaf prompts for each leaf (key, path): a template (prompt_template, variables) and values chosen by hash.

    Templates are numbered by their text and met by join, so their number isn't bounded.
    """
    distinct = templates.select("prompt_template", "variables").dropDuplicates(["prompt_template"])
    choices = stored(numbered(distinct, "prompt_template", name="choice"))
    n = choices.count()
    used = {r[0] for r in choices.select(F.explode("variables").alias("name")).where(F.col("name").isin(*POOLS)).distinct().collect()}
    # Leaves are few files beside their prompts. Values are drawn below the join, once a row: inlined into the filling,
    # they would be drawn anew for each variable of a template.
    leaves = leaves.select(key, "path", F.array_join("path", " > ").alias("category")).repartition(leaves.sparkSession.sparkContext.defaultParallelism * 4, key)
    draws = leaves.select("*", F.explode(F.sequence(F.lit(0), F.lit(per_leaf - 1))).alias("k"))
    values: dict[str, Column] = {name: pick(pool, F.lit(f"{seed} {name}"), key, "k") for name, pool in POOLS.items() if name in used}
    named = F.create_map(*[x for name, value in ({"web_category": F.col("category")} | values).items() for x in (F.lit(name), value)])
    drawn = draws.select("*", (hash_number(F.lit(str(seed)), key, "k") % max(n, 1)).alias("choice"), named.alias("named"))
    filled = fill_template(F.col("prompt_template"), F.col("variables"), F.col("named"))
    return drawn.join(small(choices), "choice").select(key, "k", filled.alias("prompt"), F.col("category").alias("web_category"), F.col("path").alias("category_path"))


def quotas(spark, target: int, weights: list[tuple[str, float]] = CATEGORY_WEIGHTS, exact: bool = False) -> DataFrame:
    """(position, category_name, n): int(target * weight), and one more for the first categories while rows are missing.

    At most one more for each, so the sum may stay below the target; exact repeats the top-up until it is reached.
    """
    n = [int(target * w) for _, w in weights]
    missing = target - sum(n)
    while missing > 0:
        for i in range(min(missing, len(n))):
            n[i] += 1
        missing = missing - len(n) if exact else 0
    return spark.createDataFrame([(i, name, k) for i, ((name, _), k) in enumerate(zip(weights, n))], "position int, category_name string, n int")


def synthesise(quota: DataFrame, tasks: DataFrame, technologies: list[str] = TECHNOLOGIES) -> DataFrame:
    """Quota rows (position, category_name, i, base_task, tech_stack): row i takes task i and technology i, both cyclic.

    tasks: (category_name, nth, base_task), nth from 0 in each category. Tasks are met by their number, so a category
    may have any number of them; a category without tasks gives no rows.
    """
    counts = tasks.groupBy("category_name").agg(F.count("*").alias("tasks"))
    rows = quota.where("n > 0").join(counts, "category_name").select("position", "category_name", "tasks", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("i"))
    tech = F.element_at(F.array(*map(F.lit, technologies)), (F.col("i") % len(technologies) + 1).cast("int"))
    met = rows.withColumn("nth", F.col("i") % F.col("tasks")).join(tasks, ["category_name", "nth"])
    return met.select("position", "category_name", "i", "base_task", tech.alias("tech_stack"))


def number_tasks(tasks: DataFrame, category: str, order: str) -> DataFrame:
    """tasks with `nth`, their place from 0 within the category."""
    placed = stored(numbered(tasks, category, order, name="place"))
    first = placed.groupBy(category).agg(F.min("place").alias("first"))
    return placed.join(F.broadcast(first), category).withColumn("nth", F.col("place") - F.col("first")).drop("place", "first")


def make_nodes(names: DataFrame, name_col: str = "name", root: str = "ROOT") -> DataFrame:
    """(node_id, parent_id, name, depth, is_leaf): a root, and a child for each distinct name, numbered by name."""
    kids = numbered(names.select(F.col(name_col).cast("string").alias("name")).where("name IS NOT NULL").distinct(), "name")
    kids = kids.select((F.col("position") + 1).alias("node_id"), F.lit(0).cast("long").alias("parent_id"), "name", F.lit(1).alias("depth"), F.lit(False).alias("is_leaf"))
    top = names.sparkSession.range(1).select(F.col("id").alias("node_id"), F.lit(None).cast("long").alias("parent_id"), F.lit(root).alias("name"), F.lit(0).alias("depth"), F.lit(False).alias("is_leaf"))
    return top.unionByName(kids)


def full_checklist(own: Column, universal: Column) -> Column:
    """A category's items, then the universal ones."""
    return F.concat(own, universal)


def render_prompt(template: str, columns: list[str], lists: list[str] = ()) -> Column:
    """A prompt text: `{name}` stands for a column; those in `lists` are turned into dashed lines."""
    out: Column = F.lit(template)
    for name in columns:
        value = F.coalesce(F.col(name).cast("string"), F.lit(""))
        out = F.replace(out, F.lit("{" + name + "}"), bullet_list(value) if name in lists else value)
    return out
