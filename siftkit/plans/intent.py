"""J6 exact keyword intent and J7 fuzzy keyword intent."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import (ACTIVE_MERCHANT, DICTIONARY_DISTANCE, MAX_LENGTH_GAP, NER_ATTRIBUTES, NER_DISTANCE,
                      PRODUCT_TYPE_ATTRIBUTE)
from ..functions.text import norm_dict, norm_str
from ..operators.nested import explode_two_levels
from ..operators.skew import salted_join
from ..operators.similarity import (best_match, keyed_candidates, similarity_candidates,
                                    step_threshold)

KW = "search_internal_keyword"
Stage = Callable[[DataFrame, str], DataFrame]


def intent_label(brand: Column, product_type: Column, seller: Column) -> Column:
    """U4: mixed (any two) > brand > seller > product_type > other; inputs are non-null booleans."""
    two = (brand & product_type) | (brand & seller) | (product_type & seller)
    return (F.when(two, "mixed").when(brand, "brand").when(seller, "seller")
            .when(product_type, "product_type").otherwise("other"))


# ---------------------------------------------------------------- inputs
def base_keywords(keywords: DataFrame) -> DataFrame:
    """Distinct keywords with their normalised form (normalised once per distinct value)."""
    return keywords.select(KW).distinct().withColumn("normalized_keyword", norm_str(F.col(KW)))


def ner_values(ner: DataFrame) -> DataFrame:
    """N18 + P6: (keyword, attribute, raw value) for brand and product-type attributes."""
    return explode_two_levels(ner, [KW], "attributes", F.col("__r.attribute_name").isin(*NER_ATTRIBUTES),
                              "attribute_values", ["attribute_name"], "attribute_value_raw")


def ner_flat(ner: DataFrame) -> DataFrame:
    return ner_values(ner).withColumn("attribute_value_norm", norm_str(F.col("attribute_value_raw")))


def brand_names(brands: DataFrame) -> DataFrame:
    """Brands not marked for deletion and valid (null flags exclude)."""
    return brands.where((F.col("mark_for_delete") == F.lit(False)) & (F.col("valid_brand") == F.lit(True)))


def product_type_values(attributes: DataFrame) -> DataFrame:
    """N17 + P17: product-type values predicted for items with a SKU."""
    std = attributes.where(F.col("item_sku").isNotNull()).select(F.explode("std_prediction").alias("__s"))
    return (std.where(F.col("__s.attribute_name") == F.lit(PRODUCT_TYPE_ATTRIBUTE))
            .select(F.col("__s.attribute_value").alias("attribute_value")))


def exact_sellers(sellers: DataFrame) -> DataFrame:
    """Active company merchants not deleted, with a partner code."""
    return sellers.where((F.col("merchant_status") == F.lit(ACTIVE_MERCHANT))
                         & (F.col("company_merchant_flag") == F.lit(True))
                         & (F.col("mark_for_delete") == F.lit(False))
                         & F.col("business_partner_code").isNotNull())


def dictionary(values: DataFrame, raw: str, out_raw: str, out_norm: str) -> DataFrame:
    """Distinct (raw, normalised) dictionary entries; normalised once per distinct raw value."""
    d = values.select(F.col(raw).alias(out_raw)).distinct()
    return d.withColumn(out_norm, norm_str(F.col(out_raw)))


def exact_match(base: DataFrame, dict_df: DataFrame, norm: str, raw: str, flag: str, out_raw: str,
                drop_empty: bool = False) -> DataFrame:
    """N8 + P15: keywords whose normalised form equals a dictionary entry's (one row per entry).

    All keywords without a Latin letter or digit normalise to '', so that key can be hot; its rows are salted.
    """
    d = dict_df.where(F.col(norm) != F.lit("")) if drop_empty else dict_df
    j = salted_join(base.select(KW, F.col("normalized_keyword").alias("__norm")),
                    d.select(F.col(raw).alias(out_raw), F.col(norm).alias("__norm")), "__norm", F.col(KW))
    return j.select(KW, F.lit(True).alias(flag), out_raw)


def ner_exact(base: DataFrame, flat: DataFrame) -> DataFrame:
    """A9 + A10: per keyword, whether a brand / product-type NER value equals it, and the raw value."""
    j = base.join(flat.select(KW, "attribute_name", "attribute_value_raw", "attribute_value_norm"), KW, "inner")
    m = F.col("normalized_keyword") == F.col("attribute_value_norm")
    is_b = (F.col("attribute_name") == F.lit("brand")) & m
    is_p = (F.col("attribute_name") == F.lit("product_type")) & m
    return j.groupBy(KW).agg(
        F.bool_or(is_b).alias("is_brand_exact_ner"),
        F.bool_or(is_p).alias("is_product_type_exact_ner"),
        F.max(F.when(is_b, F.col("attribute_value_raw"))).alias("matched_brand_raw_ner"),
        F.max(F.when(is_p, F.col("attribute_value_raw"))).alias("matched_product_type_raw_ner"),
    )


def keyword_intent_exact(keywords: DataFrame, ner: DataFrame, brands: DataFrame, attributes: DataFrame,
                         sellers: DataFrame, drop_empty: bool = False, stage: Stage | None = None) -> DataFrame:
    """Exact intent per keyword (13 columns).

    Several raw dictionary spellings with one normalised form give several
    rows for a keyword (kept). ``drop_empty`` stops keywords that normalise
    to '' from matching entries that do too.
    """
    base = base_keywords(keywords)
    if stage is not None:
        base = stage(base, "base_keywords")
    be = exact_match(base, dictionary(brand_names(brands), "brand_name", "brand_raw", "brand_norm"),
                     "brand_norm", "brand_raw", "is_brand_exact_master", "matched_brand_raw_master", drop_empty)
    pe = exact_match(base, dictionary(product_type_values(attributes), "attribute_value", "product_type_raw",
                                      "product_type_norm"),
                     "product_type_norm", "product_type_raw", "is_product_type_exact_dict",
                     "matched_product_type_raw_master", drop_empty)
    se = exact_match(base, dictionary(exact_sellers(sellers), "business_partner_name", "seller_raw", "seller_norm"),
                     "seller_norm", "seller_raw", "is_seller_exact", "matched_seller_raw", drop_empty)
    ne = ner_exact(base, ner_flat(ner))
    out = base.join(be, KW, "left").join(pe, KW, "left").join(se, KW, "left").join(ne, KW, "left")
    brand = F.coalesce(F.col("is_brand_exact_master"), F.col("is_brand_exact_ner"), F.lit(False))
    ptype = F.coalesce(F.col("is_product_type_exact_dict"), F.col("is_product_type_exact_ner"), F.lit(False))
    seller = F.coalesce(F.col("is_seller_exact"), F.lit(False))
    return out.select(
        KW, "normalized_keyword",
        "is_brand_exact_ner", "is_brand_exact_master",
        (F.coalesce(F.col("is_brand_exact_master"), F.lit(False))
         | F.coalesce(F.col("is_brand_exact_ner"), F.lit(False))).alias("is_brand_exact"),
        "is_product_type_exact_dict", "is_product_type_exact_ner",
        (F.coalesce(F.col("is_product_type_exact_dict"), F.lit(False))
         | F.coalesce(F.col("is_product_type_exact_ner"), F.lit(False))).alias("is_product_type_exact"),
        seller.alias("is_seller_exact"),
        F.coalesce(F.col("matched_brand_raw_master"), F.col("matched_brand_raw_ner")).alias("matched_brand_raw"),
        F.coalesce(F.col("matched_product_type_raw_master"),
                   F.col("matched_product_type_raw_ner")).alias("matched_product_type_raw"),
        "matched_seller_raw",
        intent_label(brand, ptype, seller).alias("intent_type_exact"),
    )


# ---------------------------------------------------------------- fuzzy
def _normaliser(name: str) -> Callable[[Column], Column]:
    return {"reference": norm_dict, "norm_str": norm_str}[name]


def _raw_dictionaries(brands: DataFrame, attributes: DataFrame, sellers: DataFrame) -> dict[str, DataFrame]:
    return {
        "brand": brand_names(brands).select(F.col("brand_name").alias("__raw")),
        "product_type": product_type_values(attributes).select(F.col("attribute_value").alias("__raw")),
        "seller": (sellers.where(F.col("business_partner_code").isNotNull())
                   .select(F.col("business_partner_name").alias("__raw"))),
    }


def fuzzy_dictionaries(brands: DataFrame, attributes: DataFrame, sellers: DataFrame,
                       normalizer: str = "reference", distinct: bool = True) -> dict[str, DataFrame]:
    """The three fuzzy dictionaries as single ``value`` columns (sellers need only a code).

    With ``distinct`` (enough for best-match search) raw values are
    de-duplicated before the Python-side normalisation.
    """
    f = _normaliser(normalizer)
    return {k: (v.distinct() if distinct else v).select(f(F.col("__raw")).alias("value"))
            for k, v in _raw_dictionaries(brands, attributes, sellers).items()}


def tagged_dictionary(brands: DataFrame, attributes: DataFrame, sellers: DataFrame,
                      normalizer: str = "reference") -> DataFrame:
    """The three fuzzy dictionaries as distinct (dictionary, value), each raw value normalised once."""
    raw = [v.select(F.lit(k).alias("dictionary"), "__raw")
           for k, v in _raw_dictionaries(brands, attributes, sellers).items()]
    every = raw[0].unionByName(raw[1]).unionByName(raw[2]).distinct()
    return every.select("dictionary", _normaliser(normalizer)(F.col("__raw")).alias("value")).distinct()


def ner_norm(ner: DataFrame, normalizer: str = "reference") -> DataFrame:
    f = _normaliser(normalizer)
    return ner_values(ner).select(KW, "attribute_name", f(F.col("attribute_value_raw")).alias("ner_value"))


_DICT_T = step_threshold(*DICTIONARY_DISTANCE)
_NER_T = step_threshold(*NER_DISTANCE)


def fuzzy_dictionary_match(queries: DataFrame, values: DataFrame, out: str) -> DataFrame:
    """N12 + W2: best dictionary value per keyword.

    The seller rule's "length <= 3 needs equality" branch is implied by
    "length <= 7 and distance <= 1", so all three dictionaries share one rule.
    """
    cand = similarity_candidates(queries, KW, "normalized_keyword", values, "value", _DICT_T, MAX_LENGTH_GAP,
                                 nearest=True)
    return best_match(cand, KW, "value", out)


def fuzzy_ner_match(queries: DataFrame, ner_vals: DataFrame, attribute: str, out: str) -> DataFrame:
    """N13 + W2: best NER value of the keyword's own NER results."""
    vals = ner_vals.where(F.col("attribute_name") == F.lit(attribute)).select(KW, F.col("ner_value").alias("value"))
    cand = keyed_candidates(queries, KW, "normalized_keyword", vals, "value", _NER_T)
    return best_match(cand, KW, "value", out)


FUZZY_FLAGS = ("is_brand_exact", "is_product_type_exact", "is_seller_exact")


def fuzzy_queries(exact: DataFrame) -> DataFrame:
    """One row per keyword of the exact table (its duplicates carry equal flags)."""
    return exact.select(KW, "normalized_keyword", *FUZZY_FLAGS).distinct()


def keyword_intent_fuzzy(exact: DataFrame, ner: DataFrame, brands: DataFrame, attributes: DataFrame,
                         sellers: DataFrame, normalizer: str = "reference", stage: Stage | None = None) -> DataFrame:
    """Fuzzy intent per row of the exact table (13 columns).

    Candidates are searched only for keywords whose exact flag is false;
    fuzzy flags include the exact flag. The three dictionaries are searched in one
    segment join and the NER values in one join by keyword. ``stage`` (optional) stores the
    distinct keywords and the normalised values once, so each value is normalised once.
    """
    q = fuzzy_queries(exact)
    values, nv = tagged_dictionary(brands, attributes, sellers, normalizer), ner_norm(ner, normalizer)
    if stage is not None:
        q, values, nv = stage(q, "fuzzy_keywords"), stage(values, "fuzzy_values"), stage(nv, "ner_values")
    flag = {"brand": "is_brand_exact", "product_type": "is_product_type_exact", "seller": "is_seller_exact"}

    def wanted(kinds: tuple[str, ...], tag: str) -> DataFrame:
        """A row for each keyword and dictionary in which it is still to be searched."""
        open_ = F.filter(F.array(*[F.when(~F.col(flag[k]), F.lit(k)) for k in kinds]), lambda k: k.isNotNull())
        return q.select(KW, "normalized_keyword", F.explode(open_).alias(tag))

    def best(candidates: DataFrame, tag: str, out: dict[str, str]) -> DataFrame:
        """W2 for several tags in one aggregation: the closest value of each, ties to the smallest."""
        b = candidates.groupBy(KW).agg(*[F.min(F.when(F.col(tag) == k, F.struct("distance", "value"))).alias(c)
                                         for k, c in out.items()])
        return b.select(KW, *[F.col(f"{c}.value").alias(c) for c in out.values()])

    master = best(similarity_candidates(wanted(tuple(flag), "dictionary"), KW, "normalized_keyword", values, "value",
                                        _DICT_T, MAX_LENGTH_GAP, tags=("dictionary",), nearest=True), "dictionary",
                  {k: f"matched_{k}_master" if k != "seller" else "matched_seller" for k in flag})
    of_ner = wanted(NER_ATTRIBUTES, "attribute_name")
    own = best(keyed_candidates(of_ner, KW, "normalized_keyword",
                                nv.select(KW, "attribute_name", F.col("ner_value").alias("value")).distinct(), "value", _NER_T,
                                tags=("attribute_name",)), "attribute_name",
               {k: f"matched_{k}_ner" for k in NER_ATTRIBUTES})
    out = exact.select(KW, "normalized_keyword", *FUZZY_FLAGS).join(master, KW, "left").join(own, KW, "left")
    has = lambda c: F.col(c).isNotNull()
    brand_m, brand_n = has("matched_brand_master"), has("matched_brand_ner")
    pt_m, pt_n = has("matched_product_type_master"), has("matched_product_type_ner")
    brand = F.col("is_brand_exact") | brand_m | brand_n
    ptype = F.col("is_product_type_exact") | pt_m | pt_n
    seller = F.col("is_seller_exact") | has("matched_seller")
    return out.select(
        KW, "normalized_keyword",
        (F.col("is_brand_exact") | brand_m).alias("is_brand_fuzzy_master"),
        (F.col("is_brand_exact") | brand_n).alias("is_brand_fuzzy_ner"),
        (F.col("is_product_type_exact") | pt_m).alias("is_product_type_fuzzy_master"),
        (F.col("is_product_type_exact") | pt_n).alias("is_product_type_fuzzy_ner"),
        seller.alias("is_seller_fuzzy"),
        "matched_brand_master", "matched_brand_ner", "matched_product_type_master",
        "matched_product_type_ner", "matched_seller",
        intent_label(brand, ptype, seller).alias("intent_type_fuzzy"),
    )
