"""Category taxonomy (O17) as a parameter of the cleaning operators.

The cleaning rules use three sets of category aliases: an allow-list of
food and bar categories, a deny-list of shop types that are never kept, and
the subset of cuisines reported as ``ethnic_category``.  They are carried in
a :class:`Taxonomy` value so a caller can pass their own; the
defaults below are the fixed values the results must match.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the source pipeline's sets; alphabetical order).
# Aliases that are never kept, whatever else a business is tagged with.
DENY_ALIASES = """
    convenience drugstores grocery
""".split()

# Cuisine aliases reported as the ethnic category (104 entries).
ETHNIC_ALIASES = """
    afghani african arabian argentine armenian asianfusion australian austrian bangladeshi
    basque belgian brazilian british bulgarian burmese cajun calabrian cambodian cantonese
    caribbean chinese colombian cuban czech dominican egyptian eritrean ethiopian filipino
    french georgian german greek guamanian hainan haitian halal hawaiian himalayan hkcafe
    honduran hungarian iberian indonesian indpak irish italian jaliscan japanese korean kosher
    laotian latin lebanese malaysian mexican mideastern modern_european mongolian moroccan
    newamerican newcanadian newmexican nicaraguan northernmexican oaxacan pakistani panasian
    persian peruvian polish polynesian portuguese poutineries puertorican russian salvadoran
    sardinian scandinavian scottish senegalese shanghainese sicilian singaporean slovakian
    somali southafrican southern spanish srilankan syrian szechuan taiwanese tex-mex thai
    tradamerican trinidadian turkish tuscan ukrainian uzbek venezuelan vietnamese yucatan
""".split()

# Food and bar aliases: a business is kept when any alias is here (211 entries).
FOOD_AND_BAR_ALIASES = """
    acaibowls afghani african arabian argentine armenian asianfusion australian austrian bagels
    bakeries bangladeshi bars basque bbq beerbar beergardens belgian bistros brazilian
    breakfast_brunch breweries brewpubs british bubbletea buffets bulgarian burgers burmese
    cafes cajun cakeshop calabrian cambodian cantonese caribbean champagne_bars cheesesteaks
    chicken_wings chickenshop chimneycakes chinese chocolate churros cideries cocktailbars
    coffee coffeeroasteries colombian comfortfood conveyorsushi creperies cuban cupcakes czech
    delis desserts dimsum diners dinnertheater divebars diyfood dominican donuts egyptian
    empanadas eritrean ethiopian falafel filipino fishnchips fondue food food_court foodstands
    foodtrucks french gastropubs gaybars gelato georgian german gluten_free gourmet greek
    guamanian hainan haitian halal hawaiian himalayan hkcafe honduran honey hotdog hotdogs
    hotpot hungarian iberian icecream indonesian indpak irish irish_pubs italian izakaya
    jaliscan japacurry japanese juicebars kebab kombucha korean kosher laotian latin lebanese
    macarons malaysian meaderies mediterranean mexican mideastern modern_european mongolian
    moroccan newamerican newcanadian newmexican nicaraguan noodles northernmexican oaxacan
    pakistani panasian pancakes pastashops persian peruvian piadina pizza poke polish polynesian
    portuguese poutineries pretzels pubs puertorican ramen raw_food restaurants
    rotisserie_chicken russian salad salvadoran sandwiches sardinian scandinavian scottish
    seafood senegalese shanghainese shavedsnow sicilian singaporean slovakian smokehouse somali
    soulfood soup southafrican southern spanish speakeasies sportsbars srilankan steak
    streetvendors sushi syrian szechuan tacos taiwanese tamales tapas tapasmallplates tea
    teppanyaki tex-mex thai themedcafes tikibars tradamerican trinidadian turkish tuscan
    ukrainian uzbek vegan vegetarian venezuelan vermouthbars vietnamese waffles whiskeybars
    wine_bars wineries winetastingroom wraps yucatan
""".split()

# Bars among them; ``winebars`` is listed as a bar and as food, but not among the food and bars.
BAR_ALIASES = """
    bars beerbar beergardens breweries brewpubs champagne_bars cocktailbars divebars gastropubs
    gaybars irish_pubs meaderies pubs sportsbars tapas tikibars vermouthbars whiskeybars winebars
    wineries winetastingroom
""".split()
FOOD_AND_BAR = "winebars"

# Label used when a business has no ethnic alias.
NO_ETHNIC_LABEL = "Not Specified"
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Taxonomy:
    allow: tuple[str, ...] = tuple(FOOD_AND_BAR_ALIASES)
    deny: tuple[str, ...] = tuple(DENY_ALIASES)
    ethnic: tuple[str, ...] = tuple(ETHNIC_ALIASES)

    def allow_col(self) -> Column:
        return literal_array(self.allow)

    def deny_col(self) -> Column:
        return literal_array(self.deny)

    def ethnic_col(self) -> Column:
        return literal_array(self.ethnic)


DEFAULT_TAXONOMY = Taxonomy()


def literal_array(values) -> Column:
    """A constant ``array<string>``; folded by Catalyst into one literal."""
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def classify_alias(alias: Column, taxonomy: Taxonomy = DEFAULT_TAXONOMY) -> Column:
    """Which sets an alias belongs to, as a struct of three booleans."""
    return F.struct(
        F.array_contains(taxonomy.allow_col(), alias).alias("is_food_or_bar"),
        F.array_contains(taxonomy.deny_col(), alias).alias("is_denied"),
        F.array_contains(taxonomy.ethnic_col(), alias).alias("is_ethnic"),
    )


#: The seven sets, in the order of their bits.
SETS = ("all", "nonfood", "definitely_no", "food_and_bars", "food", "bars", "ethnicities")


def taxonomy_table(spark: SparkSession, taxonomy: Taxonomy = DEFAULT_TAXONOMY,
                   nonfood: DataFrame | None = None) -> DataFrame:
    """(set_name, alias) of the seven sets: fixed values, and what follows from
    them.  Food is what is left of food and bars without the bars; ``nonfood``
    (alias), a list too long to be kept here, is a table; all is food and bars, and it."""
    allow = list(taxonomy.allow)
    food = [a for a in [*allow, FOOD_AND_BAR] if a not in BAR_ALIASES or a == FOOD_AND_BAR]
    known = {"definitely_no": taxonomy.deny, "food_and_bars": allow, "food": food, "bars": BAR_ALIASES,
             "ethnicities": taxonomy.ethnic, "all": allow}
    rows = None
    for name, aliases in known.items():
        part = spark.range(1).select(F.lit(name).alias("set_name"), F.explode(literal_array(aliases)).alias("alias"))
        rows = part if rows is None else rows.unionByName(part)
    if nonfood is not None:
        for name in ("nonfood", "all"):
            rows = rows.unionByName(nonfood.select(F.lit(name).alias("set_name"), "alias"))
    return rows.distinct()


def alias_masks(sets: DataFrame) -> DataFrame:
    """(alias, mask): one bit for each of ``SETS`` that has the alias."""
    bit = F.lit(0)
    for i, name in enumerate(SETS):
        bit = F.when(F.col("set_name") == name, F.lit(1 << i)).otherwise(bit)
    return sets.groupBy("alias").agg(F.bit_or(bit).alias("mask")).filter("alias is not null")


def with_class_mask(df: DataFrame, sets: DataFrame, aliases: str = "categories", name: str = "class_mask") -> DataFrame:
    """``df`` with the sets its aliases meet, as one mask: an alias is in a set if
    its bit is there, a row meets a set if any alias does (none: 0).

    Each distinct alias list is looked up once; the lists are few beside the rows.
    """
    key = F.to_json(F.coalesce(F.col(aliases), F.array().cast("array<string>")))
    keyed = df.withColumn("_list", key)
    lists = keyed.select("_list").distinct()
    each = lists.select("_list", F.explode(F.from_json("_list", "array<string>")).alias("alias"))
    masks = each.join(alias_masks(sets), "alias").groupBy("_list").agg(F.bit_or("mask").alias(name))
    return keyed.join(masks, "_list", "left").drop("_list").withColumn(name, F.coalesce(name, F.lit(0)))


def meets(mask: str, set_name: str) -> Column:
    return F.col(mask).bitwiseAND(F.lit(1 << SETS.index(set_name))) != 0
