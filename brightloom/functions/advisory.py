"""Advisory texts by audience and risk level."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Message texts. Placeholders: {area}, {pct}, {hours}, {risk}, {window}.
RESIDENT_HIGH = (
    "Wilayah {area} berisiko TINGGI banjir ({pct}%) dalam {hours} jam ke depan. "
    "Segera pindahkan kendaraan ke tempat tinggi, siapkan tas darurat berisi dokumen penting "
    "dan obat-obatan, dan pantau ketinggian air pintu air Manggarai. "
    "Jika air mulai naik di sekitar rumah, segera evakuasi ke titik aman terdekat."
)
RESIDENT_WATCH = (
    "Wilayah {area} dalam status WASPADA banjir ({pct}%) dalam {hours} jam ke depan. "
    "Pantau perkembangan cuaca dan ketinggian air, siapkan rencana evakuasi keluarga, "
    "dan simpan barang berharga di tempat yang lebih tinggi."
)
RESIDENT_SAFE = (
    "Wilayah {area} dalam status AMAN ({pct}% risiko) untuk {hours} jam ke depan. Tetap pantau update."
)
AGENCY = (
    "PRIORITAS {risk}: {area}, probabilitas banjir {pct}% dalam {hours} jam. "
    "Rekomendasi: pre-positioning 2 perahu karet di pos siaga terdekat, "
    "koordinasi dengan kelurahan untuk identifikasi lansia/disabilitas yang perlu evakuasi dini, "
    "siapkan posko logistik dengan kapasitas 200 jiwa. Window aksi: {window} jam."
)
PLANNER = (
    "Analisis {area}: probabilitas banjir {pct}% horizon {hours}h didorong oleh faktor "
    "hidrologis dan tutupan lahan. Pola ini konsisten dengan kelurahan dengan elevasi rendah "
    "dan akumulasi curah hujan tinggi. Implikasi: prioritas program RTH dan normalisasi drainase "
    "di wilayah ini untuk mitigasi jangka panjang."
)
# The alert for operators. Placeholders: {ts}, {risk}, {pct}, {hours}, {drivers}.
ALERT = (
    "[{ts}] PERINGATAN BANJIR — Level: {risk}\n"
    "Probabilitas: {pct}% dalam {hours} jam ke depan\n"
    "Faktor utama:\n{drivers}"
)
DRIVER_LINE = "  • {name}: {value} ({direction})"


def fill(template: Column, values: dict[str, Column]) -> Column:
    for name, value in values.items():
        template = F.replace(template, F.lit("{" + name + "}"), value.cast("string"))
    return template


def advisory_text(audience: Column, area: Column, prob: Column, hours: Column, risk: Column) -> Column:
    template = (
        F.when((audience == "warga") & risk.isin("Siaga", "Awas"), RESIDENT_HIGH)
        .when((audience == "warga") & (risk == "Waspada"), RESIDENT_WATCH)
        .when(audience == "warga", RESIDENT_SAFE)
        .when(audience == "bpbd", AGENCY)
        .otherwise(PLANNER)
    )
    return fill(template, {
        "area": area, "pct": F.bround(prob * 100, 0).cast("int"), "hours": hours,
        "risk": F.upper(risk), "window": F.greatest(F.lit(2), hours - 4),
    })


def alert_text(ts: Column, prob: Column, hours: Column, risk: Column, drivers: Column) -> Column:
    """Alert with its drivers, an ordered array of struct(feature, value, direction)."""
    listed = F.transform(drivers, lambda d: fill(F.lit(DRIVER_LINE), {
        "name": F.translate(d["feature"], "_", " "), "value": F.format_string("%.1f", d["value"]), "direction": d["direction"]}))
    return fill(F.lit(ALERT), {
        "ts": ts, "risk": risk, "pct": F.format_string("%.1f", prob * 100), "hours": hours, "drivers": F.array_join(listed, "\n")})
