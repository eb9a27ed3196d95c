"""Listings out of stored pages and payloads.

``extract_*`` turn a table of pages into one JSON payload per listing;
``normalize_listings`` turns payloads of one portal into the common columns.
A row fans out only to what its own page holds; broken JSON yields nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelle.functions.cleaning import title_case, to_number
from parcelle.functions.scores import steady_round
from parcelle.operators.columns import computed_once

# --- fixed values: where portals embed their data -------------------------------
LD_JSON = r'(?is)<script[^>]*type\s*=\s*["\']?[^"\'>]*application/ld\+json[^>]*>(.*?)</script>'
NEXT_DATA = r'(?is)<script[^>]*id\s*=\s*["\']?__NEXT_DATA__["\']?[^>]*>(.*?)</script>'
BOOTSTRAP = r"(?s)var searchBootstrap = (\{.*?\});"
CARD_START = r'(?i)(?=<[a-z]+[^>]*class\s*=\s*["\'][^"\']*residenceCard)'
HREF = r'(?is)<a[^>]*href\s*=\s*["\']([^"\']*)["\']'
CARD_SURFACE = r"(\d+(?:[.,]\d+)?)\s*m[²2]"
CARD_ROOMS = r"(?i)(\d+)\s*pi[eè]ce"
CARD_CITY = r"([A-Z][A-Z\-\s]+)\s*\(\d{5}\)"
CDC_BASE = "https://www.cdc-habitat.fr"
BIENICI_BASE = "https://www.bienici.com"

COMMON = [
    "listing_id", "source", "commune_code", "city", "price", "surface_m2", "price_m2", "rooms",
    "postal_code", "property_type", "energy_class", "url", "title", "photo", "latitude",
    "longitude", "scraped_at",
]


def _elements(json_array: Column) -> Column:
    """Elements of a JSON array as JSON texts; anything else gives no element."""
    parsed = F.when(F.ltrim(json_array).startswith("["), F.from_json(json_array, "array<string>"))
    return F.coalesce(parsed, F.array().cast("array<string>"))


def _field(payload: Column, *paths: str) -> Column:
    found = [F.get_json_object(payload, f"$.{p}") for p in paths]
    return F.coalesce(*found) if len(found) > 1 else found[0]


def extract_embedded_json(pages: DataFrame, html: str = "html") -> DataFrame:
    """Adds ``payload`` (JSON text), one row per embedded listing.

    The page-data script comes first; only without listings there are the linked
    data scripts used, each of which holds an object or an array.
    """
    page_data = F.regexp_extract(F.col(html), NEXT_DATA, 1)
    listed = _elements(_field(page_data, "props.pageProps.listings", "props.pageProps.results"))
    scripts = F.regexp_extract_all(F.col(html), F.lit(LD_JSON), F.lit(1))
    linked = F.flatten(
        F.transform(
            scripts,
            lambda s: F.when(F.ltrim(s).startswith("["), _elements(s)).when(
                F.try_parse_json(s).isNotNull(), F.array(F.trim(s))
            ).otherwise(F.array().cast("array<string>")),
        )
    )
    payloads = F.when(F.size(listed) > 0, listed).otherwise(linked)
    return pages.withColumn("payload", F.explode(payloads)).where(
        F.try_parse_json("payload").isNotNull()
    )


def extract_lots(pages: DataFrame, html: str = "html") -> DataFrame:
    """Adds ``payload`` (one lot of the search script) and its matching ``card``."""
    lots = _elements(F.get_json_object(F.regexp_extract(F.col(html), BOOTSTRAP, 1), "$.lots"))
    pieces = F.split(F.col(html), CARD_START)
    cards = F.transform(
        F.slice(pieces, 2, F.greatest(F.size(pieces), F.lit(1))),
        lambda piece: F.struct(
            F.regexp_extract(piece, HREF, 1).alias("href"), card_text(piece).alias("text")
        ),
    )
    rows = pages.withColumns({"_cards": cards}).withColumn("payload", F.explode(lots))
    lot, article = F.coalesce(_field(F.col("payload"), "id_lot"), F.lit("")), _field(F.col("payload"), "id_article")
    matching = F.filter(
        "_cards",
        lambda c: F.contains(c["href"], lot)
        | F.coalesce((article != "") & F.contains(c["href"], article), F.lit(False)),
    )
    return rows.withColumn("card", F.get(matching, F.lit(0))).drop("_cards")


def card_text(html: Column) -> Column:
    """Visible text: tags out, the usual entities in, single spaces."""
    bare = F.regexp_replace(html, r"(?s)<[^>]*>", " ")
    for entity, char in (("&nbsp;", " "), (" ", " "), ("&sup2;", "²"), ("&egrave;", "è"), ("&amp;", "&")):
        bare = F.replace(bare, F.lit(entity), F.lit(char))
    return F.trim(F.regexp_replace(bare, r"\s+", " "))


def card_surface(text: Column) -> Column:
    return to_number(F.regexp_extract(text, CARD_SURFACE, 1))


def card_rooms(text: Column) -> Column:
    return F.regexp_extract(text, CARD_ROOMS, 1).try_cast("int")


def card_type(text: Column) -> Column:
    low = F.lower(text)
    return F.when(F.contains(low, F.lit("maison")), "maison").when(
        F.contains(low, F.lit("studio")), "studio"
    ).otherwise("appartement")


def card_city(text: Column) -> Column:
    found = F.trim(F.regexp_extract(text, CARD_CITY, 1))
    return F.when(found != "", title_case(found))


# One parse per payload: every accepted spelling is a text field of the schema.
_SELOGER = (
    "id string, idAnnonce string, price string, prix string, surface string, surfaceArea string, "
    "rooms string, nombreDePieces string, city string, ville string, "
    "address struct<addressLocality: string>, postalCode string, codePostal string, "
    "url string, lien string, type string, typeBien string"
)


def _seloger(ad: Column) -> dict[str, Column]:
    surface = F.split(F.replace(F.coalesce(ad["surface"], ad["surfaceArea"]), F.lit(","), F.lit(".")), "m")[0]
    return {
        "listing_id": F.coalesce(ad["id"], ad["idAnnonce"], F.lit("")),
        "price": to_number(F.replace(F.coalesce(ad["price"], ad["prix"]), F.lit("€"), F.lit(""))),
        "surface_m2": F.trim(surface).try_cast("double"),
        "rooms": to_number(F.coalesce(ad["rooms"], ad["nombreDePieces"])).try_cast("int"),
        "city": F.coalesce(ad["city"], ad["ville"], ad["address"]["addressLocality"]),
        "postal_code": F.coalesce(ad["postalCode"], ad["codePostal"]),
        "url": F.coalesce(ad["url"], ad["lien"], F.lit("")),
        "property_type": F.coalesce(ad["type"], ad["typeBien"]),
    }


_LEBONCOIN = (
    "list_id string, url string, price array<string>, "
    "location struct<city: string, zipcode: string>, "
    "attributes array<struct<key: string, value_label: string, values: array<string>>>"
)


# Attributes by name, the last of equal names.
_ATTRIBUTES = {"_square": "square", "_area": "rooms_surface_area", "_rooms": "rooms", "_type": "real_estate_type", "_energy": "energy_rate"}


def _leboncoin_steps(ad: Column) -> list[dict[str, Column]]:
    """Columns worked out one after the other, so that no look-up is repeated and the code of a step stays short."""
    place = lambda name: (F.size(ad["attributes"]) - F.array_position("_names", F.lit(name))).cast("int")
    text = lambda *found: F.coalesce(*[c for f in found for c in (F.col(f)["value_label"], F.get(F.col(f)["values"], F.lit(0)))])
    return [
        {"_names": F.reverse(ad["attributes"]["key"])},
        {column: F.get(ad["attributes"], place(name)) for column, name in _ATTRIBUTES.items()},
        {"_square": text("_square", "_area"), "_rooms": text("_rooms"), "_type": text("_type"), "_energy": text("_energy")},
    ]


def _leboncoin(ad: Column) -> dict[str, Column]:
    return {
        "listing_id": F.coalesce(ad["list_id"], F.lit("")),
        "price": F.get(ad["price"], F.lit(0)).try_cast("double"),
        "surface_m2": to_number(F.col("_square")),
        "rooms": F.col("_rooms").try_cast("int"),
        "city": ad["location"]["city"],
        "postal_code": ad["location"]["zipcode"],
        "url": ad["url"],
        "property_type": F.col("_type"),
        "energy_class": F.col("_energy"),
    }


_CDC_HABITAT = "id_lot string, id_article string, nb_prix string, latitude string, longitude string"


def _cdc_habitat(ad: Column) -> dict[str, Column]:
    text, href = F.col("card.text"), F.col("card.href")
    lot = F.coalesce(ad["id_lot"], F.lit(""))
    amount = F.translate(ad["nb_prix"], " \u00a0", "")
    own_page = F.concat(F.lit(f"{CDC_BASE}/annonces-immobilieres/vente/"), lot)
    return {
        "listing_id": F.concat(F.lit("cdc_"), lot, F.lit("_"), F.coalesce(ad["id_article"], F.lit(""))),
        "price": amount.try_cast("double"),
        "surface_m2": card_surface(text),
        "rooms": card_rooms(text),
        "city": F.coalesce(card_city(text), F.col("location")),
        "postal_code": F.col("_postal"),
        "url": F.when(F.coalesce(href, F.lit("")) == "", own_page)
        .when(href.startswith("http"), href)
        .otherwise(F.concat(F.lit(CDC_BASE), href)),
        "property_type": F.coalesce(card_type(text), F.lit("appartement")),
        "latitude": ad["latitude"].try_cast("double"),
        "longitude": ad["longitude"].try_cast("double"),
    }


_BIENICI = (
    "id string, title string, price string, surfaceArea string, roomsQuantity string, city string, "
    "url string, photos array<struct<url_photo: string>>"
)


def _bienici(ad: Column) -> dict[str, Column]:
    return {
        "listing_id": F.coalesce(ad["id"], F.lit("")),
        "title": F.coalesce(ad["title"], F.lit("")),
        "price": ad["price"].try_cast("double"),
        "surface_m2": ad["surfaceArea"].try_cast("double"),
        "rooms": ad["roomsQuantity"].try_cast("int"),
        "city": F.coalesce(ad["city"], F.lit("")),
        "url": F.concat(F.lit(BIENICI_BASE), F.coalesce(ad["url"], F.lit(""))),
        "photo": F.get(ad["photos"], F.lit(0))["url_photo"],
    }


_PORTALS = {
    "seloger": (_SELOGER, _seloger), "leboncoin": (_LEBONCOIN, _leboncoin),
    "cdc_habitat": (_CDC_HABITAT, _cdc_habitat), "bienici": (_BIENICI, _bienici),
}
_STEPS = {"leboncoin": _leboncoin_steps}
_TYPES = {"price": "double", "surface_m2": "double", "price_m2": "double", "rooms": "int",
          "latitude": "double", "longitude": "double"}


def normalize_listings(raw: DataFrame, portal: str) -> DataFrame:
    """Common listing columns from ``payload``, ``location`` and ``scraped_at``.

    Two portals need price and surface, one needs a price only, one nothing.
    """
    if portal not in _PORTALS:
        raise ValueError(f"unknown portal: {portal}")
    schema, read = _PORTALS[portal]
    place = F.col("_postal") if portal == "cdc_habitat" else F.col("location")
    cells = read(F.col("_ad")) | {"commune_code": place, "scraped_at": F.col("_scraped")}
    parsed = raw.withColumn("_ad", F.from_json("payload", schema)).withColumnsRenamed(
        {"postal_code": "_postal", "scraped_at": "_scraped"}
    )
    for columns in _STEPS.get(portal, lambda ad: [])(F.col("_ad")):
        parsed = parsed.withColumns(columns)
    rows = computed_once(parsed, cells).select(*cells)
    price, surface = F.col("price"), F.col("surface_m2")
    if portal in ("seloger", "leboncoin"):
        rows = rows.where((price != 0) & (surface != 0))
    elif portal == "cdc_habitat":
        rows = rows.where(price.isNotNull())
    digits = 0 if portal == "bienici" else 2
    rows = rows.withColumns(
        {
            "price_m2": F.when((surface > 0) & (price != 0), steady_round(price / surface, digits)),
            "source": F.lit(portal),
        }
    )
    return rows.select(
        *[
            (F.col(c) if c in rows.columns else F.lit(None).cast(_TYPES.get(c, "string"))).alias(c)
            for c in COMMON
        ]
    )
