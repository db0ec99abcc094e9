"""Desirability score of a model, 1 to 10, from its name, make, value, list price and age."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .expr import clamp

#: Name fragments by tier; the first tier with a fragment in the upper-cased name counts.
TIERS = (
    (4, "Ultra-rare limited production", ("ENZO", "F40", "F50", "LAFERRARI", "CLK GTR", "SLR MCLAREN", "CARRERA GT", "918 SPYDER", "P1", "SENNA", "SPEEDTAIL", "AMG ONE", "VEYRON", "CHIRON", "ZONDA", "HUAYRA", "CENTENARIO", "VENENO", "REVENTON", "MIURA", "COUNTACH", "GT40", "FORD GT", "VALKYRIE", "812 COMPETIZIONE", "288 GTO", "250 GTO", "959", "2000GT", "SLS AMG")),
    (3, "Very limited / track-focused", ("GT2 RS", "GT3 RS", "GT4 RS", "BLACK SERIES", "CSL", "Z06", "ZR1", "GT350R", "GT500", "SPORT CLASSIC", "PERFORMANTE", "SVJ", "STO", "SCUDERIA", "PISTA", "SPECIALE", "CHALLENGE STRADALE", "600LT", "765LT", "GT3 TOURING", "SPEEDSTER", "GT2", "MURCIELAGO", "AVENTADOR", "DIABLO", "AMG GT R", "GT R", "DEMON", "ACR", "NISMO", "HEMI CUDA")),
    (2, "Desirable performance model", ("GT3", "GT4", "GTS", "TURBO S", "M3", "M4", "M5", "M2", "C63", "E63", "AMG GT", "RS3", "RS4", "RS5", "RS6", "RS7", "TYPE R", "STI", "NISMO", "NSX", "SUPRA", "SKYLINE", "RX-7", "LFA", "VANTAGE", "DB11", "DBS", "CONTINENTAL GT", "WRAITH", "720S", "570S", "488", "F8", "SF90", "812")),
    (-2, "Mass-production model", ("CAYENNE", "MACAN", "PANAMERA", "URUS", "LEVANTE", "GHIBLI", "X3", "X5", "Q5", "Q7", "GLE", "GLC", "RANGE ROVER SPORT", "F-PACE", "FLYING SPUR", "CULLINAN", "BENTAYGA")),
)
#: Makes that raise or lower the score.
BRANDS = (
    (1, "Strong collector brand", ("Ferrari", "Porsche", "Lamborghini", "Bugatti", "Pagani", "Koenigsegg", "McLaren", "Aston Martin")),
    (-1, "Historically depreciates", ("Maserati", "Jaguar", "Land Rover")),
)
#: Curated scores; the longest fragment in the name replaces the computed score.
CURATED = {
    "918 SPYDER": 10, "LAFERRARI": 10, "P1": 10, "F40": 10, "F50": 10, "ENZO": 10, "CARRERA GT": 10, "SLR MCLAREN": 10, "CLK GTR": 10, "VEYRON": 10, "CHIRON": 10, "ZONDA": 10, "HUAYRA": 10, "CENTENARIO": 10, "VENENO": 10, "REVENTON": 10, "MIURA": 10, "COUNTACH": 10, "GT40": 10, "AMG ONE": 10, "SENNA": 10, "SPEEDTAIL": 10, "VALKYRIE": 10, "812 COMPETIZIONE": 10, "288 GTO": 10, "250 GTO": 10, "FORD GT": 10, "2000GT": 10, "959": 10,
    "SLS AMG": 9, "SLS AMG BLACK SERIES": 10, "SLS AMG GT FINAL EDITION": 9, "GT2 RS": 9, "GT3 RS": 9, "GT4 RS": 9, "CAYMAN GT4 RS": 9, "488 PISTA": 9, "458 SPECIALE": 9, "430 SCUDERIA": 9, "CHALLENGE STRADALE": 9, "SF90 STRADALE": 9, "SF90 SPIDER": 9, "F8 TRIBUTO": 9, "F8 SPIDER": 9, "HURACAN STO": 9, "HURACAN PERFORMANTE": 9, "AVENTADOR SVJ": 9, "765LT": 9, "600LT": 9, "720S": 9, "AMG GT BLACK SERIES": 9, "AMG GT R": 9, "GT BLACK SERIES": 9, "GT R": 9, "CORVETTE ZR1": 9, "CORVETTE Z06": 9,
    "CHALLENGER SRT DEMON": 9, "CHALLENGER SRT DEMON 170": 9, "VIPER ACR": 9, "GT-R NISMO": 9, "M3 CSL": 9, "M4 CSL": 9, "MUSTANG SHELBY GT500": 9, "MUSTANG SHELBY GT350": 9, "MUSTANG SHELBY GT350R": 9, "HEMI CUDA": 9, "CHARGER DAYTONA": 9, "12CILINDRI": 9, "12CILINDRI SPIDER": 9, "911 S/T": 10, "REVUELTO": 10, "BATUR": 10, "GT3": 8, "GT3 TOURING": 8, "TURBO S": 8, "CAYMAN GT4": 8, "SPORT CLASSIC": 8, "SPEEDSTER": 8, "812 SUPERFAST": 8, "812 GTS": 8, "F12BERLINETTA": 8, "488 GTB": 8, "488 SPIDER": 8,
    "296 GTB": 8, "296 GTS": 8, "PUROSANGUE": 8, "DB12": 7, "SPECTRE": 8, "URUS PERFORMANTE": 8, "750S": 8, "HURACAN TECNICA": 8, "AVENTADOR": 8, "AVENTADOR S": 8, "570S": 8, "ARTURA": 8, "DBS SUPERLEGGERA": 8, "DB11": 8, "M5 CS": 8, "M4 CS": 8, "M3 COMPETITION": 8, "M4 GTS": 8, "VIPER": 8, "CAMARO ZL1": 8, "CAMARO Z28": 8, "NSX": 8, "LFA": 8, "RX-7": 8,
}


def _has(name: Column, fragments) -> Column:
    return name.rlike("|".join(rf"\Q{x}\E" for x in fragments))


def desirability(model: Column, make: Column, value: Column, msrp: Column, age: Column, curated: bool = True) -> Column:
    """The score; ``curated=False`` leaves the curated table out, which knows the present and spoils backtests."""
    name = F.upper(F.coalesce(model, F.lit("")))
    tier = F.lit(0)
    for points, _, fragments in reversed(TIERS):
        tier = F.when(_has(name, fragments), points).otherwise(tier)
    manual = F.when(name.rlike("MANUAL|6-SPEED|6 SPEED"), 1).otherwise(0)
    worth = F.when(value > 500_000, 2).when(value > 200_000, 1).when(value < 30_000, -1).otherwise(0)
    ratio = F.when(msrp > 0, value / msrp)
    listed = F.when(ratio > 1.5, 2).when(ratio > 1.1, 1).otherwise(0)
    aged = F.when(age.between(20, 35) | (age >= 40), 1).otherwise(0)
    brand = F.lit(0)
    for points, _, makes in BRANDS:
        brand = F.when(make.isin(*makes), points).otherwise(brand)
    score = clamp(5 + tier + manual + worth + listed + aged + brand, 1, 10)
    if not curated:
        return score
    # longest fragment first, so the first hit wins; one piece of SQL, and looked through only where there is a hit
    entries = (f"named_struct('k', '{k}', 'v', {v})" for k, v in sorted(CURATED.items(), key=lambda kv: (-len(kv[0]), kv[0])))
    known = F.get(F.filter(F.expr(f"array({', '.join(entries)})"), lambda x: F.contains(name, x["k"])), F.lit(0))["v"]
    return F.when(_has(name, CURATED), known).otherwise(score)


def desirability_reasons(model: Column, make: Column, value: Column, msrp: Column, age: Column) -> Column:
    """What moved the computed score, in order."""
    name = F.upper(F.coalesce(model, F.lit("")))
    tier = F.lit(None).cast("string")
    for _, reason, fragments in reversed(TIERS):
        tier = F.when(_has(name, fragments), reason).otherwise(tier)
    ratio = F.when(msrp > 0, value / msrp)
    brand = F.lit(None).cast("string")
    for _, reason, makes in BRANDS:
        brand = F.when(make.isin(*makes), reason).otherwise(brand)
    said = [
        tier,
        F.when(name.rlike("MANUAL|6-SPEED|6 SPEED"), "Manual transmission"),
        F.when(value > 500_000, "High-value segment").when(value > 200_000, "Premium segment").when(value < 30_000, "Entry-level pricing"),
        F.when(ratio > 1.5, "Trading well above MSRP").when(ratio > 1.1, "Trading above MSRP"),
        F.when(age.between(20, 35), "Classic age — peak collectibility").when(age >= 40, "Vintage — established collector market"),
        brand,
    ]
    return F.array_compact(F.array(*said))


