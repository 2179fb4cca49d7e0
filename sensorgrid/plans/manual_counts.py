"""Predictions at the places and days of the manual counts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorgrid.functions.timeparts import LOCAL_TZ
from sensorgrid.operators.spatial import compare_at_points, on_local_days
from sensorgrid.schemas import SCHEMAS

# --- Fixed values: counting points (lat, lon, text), counted days, model ----------------------
COUNTING_POINTS = (
    (52.51792, 13.37813, "Dorotheenstraße (östl. Ebertstraße) (Mitte, 10555)"),
    (52.48791, 13.37319, "Monumentenstraße (Monumentenbrücke) (Schöneberg, 10829)"),
    (52.49246, 13.37181, "Yorckstraße (westl. Katzbachstraße) (Kreuzberg, 10965)"),
    (52.4968, 13.2893, "Kurfürstendamm (Höhe S-Bhf. Halensee) (Wilmersdorf, 10711)"),
    (52.47985, 13.3118, "Mecklenburgische Straße (südl. Rudolstädter Straße) (Wilmersdorf, 14197)"),
    (52.513, 13.28747, "Knobelsdorffstraße (westl. Sophie-Charlotten-Straße) (Charlottenburg, 10585)"),
    (52.5064, 13.2824, "Neue Kantstraße (Ostpreußenbrücke) (Charlottenburg, 14057)"),
    (52.50667, 13.38593, "Wilhelmstraße (südl. Zimmerstraße) (Kreuzberg, 10963)"),
    (52.47344, 13.36511, "Sachsendamm (östl. Lotte-Laserstrin-Straße (Bahnbrücke)) (Schöneberg, 12103)"),
    (52.4873, 13.4518, "Elsenstraße (nördl. Heidelberger Straße) (Neukölln, 12435)"),
    (52.46191, 13.47774, "Sonnenallee (südl. Fritzi-Massary-Straße) (Neukölln, 12437)"),
    (52.44569, 13.36768, "Ringstraße (Teubertbrücke) (Tempelhof, 12105)"),
    (52.4734, 13.54845, "Rudolf-Rühl-Allee [ehem. Köpenicker A.] (südl. Verl. Waldowallee) (Köpenick, 12459)"),
    (52.44297, 13.35392, "Attilastraße - Kaiser-Wilhelm-Straße (Sieversbrücke) (Steglitz, 12247)"),
    (52.44515, 13.33991, "Siemensstraße (Siemensbrücke) (Steglitz,12247)"),
    (52.52472, 13.24501, "Rominter Allee (südl. Charlottenburger Chaussee) (Ruhleben, 14052)"),
    (52.55944, 13.22484, "Daumstraße (Spandau, 13599)"),
    (52.56477, 13.39383, "Wollankstraße (Höhe S-Bhf. Wollankstraße) (Wedding, 13359)"),
    (52.5976, 13.3731, "Wilhelmsruher Damm (westl. Uhlandstraße) (Rosenthal, 13158)"),
    (52.5434, 13.61984, "Louis-Lewin-Straße (südl. Berliner Straße) (Hellersdorf, 12629)"),
    (52.42492, 13.5569, "Adlergestell (Stelling-Janitzky-Brücke, Teltowkanal) (Treptow, 12489)"),
    (52.42754, 13.40592, "Quarzweg (östl. Ankogelweg) (Tempelhof, 12349)"),
    (52.4214, 13.5169, "Neudecker Weg (nördl. August-Froehlich-Str.) (Rudow, 12355)"),
    (52.48009, 13.2849, "Franzensbader Straße östl. Berkaer Straße (Charlottenburg-Wilmersdorf, 14193)"),
    (52.6016, 13.286, "Hermsdorfer Damm (östl. A111) (Tegel, 13507)"),
    (52.5507, 13.46183, "Berliner Allee in Höhe Hausnr. 125 (Weißensee, 13088)"),
)
EARLIER_DAYS = (date(2022, 5, 31),)
LATER_DAYS = (date(2023, 5, 4), date(2023, 6, 28))
LATER_MODEL = 21
# ----------------------------------------------------------------------------------------------


def counting_points(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(COUNTING_POINTS, SCHEMAS["points"])


def predictions_at_counts(
    cell_coords: DataFrame,
    cell_streets: DataFrame,
    street_names: DataFrame,
    earlier: tuple[DataFrame, DataFrame],
    later: tuple[DataFrame, DataFrame],
    points: DataFrame | None = None,
    tz: str = LOCAL_TZ,
) -> DataFrame:
    """Mean scaled prediction per hour, street element and counting point on the counted days.

    ``earlier`` and ``later`` are two runs, each with its predictions and its factors; of the later
    table only one model is taken.
    """
    vintages = [
        (on_local_days(earlier[0], EARLIER_DAYS, tz=tz), earlier[1]),
        (on_local_days(later[0].filter(F.col("model_id") == LATER_MODEL), LATER_DAYS, tz=tz), later[1]),
    ]
    if points is None:
        points = counting_points(cell_coords.sparkSession)
    return compare_at_points(points, cell_coords, cell_streets, street_names, vintages)
