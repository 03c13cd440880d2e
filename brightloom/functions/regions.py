"""Entity names: regions, aliases and canonical forms."""

from __future__ import annotations

# Provinces of each region, in region order.
REGIONS = {
    "Western": [
        "Aceh", "Sumatera Utara", "Sumatera Barat", "Riau", "Kep. Riau", "Jambi", "Sumatera Selatan",
        "Bengkulu", "Lampung", "Kep. Bangka Belitung", "Dki Jakarta", "Jawa Barat", "Jawa Tengah",
        "Di Yogyakarta", "Jawa Timur", "Banten", "Kalimantan Barat", "Kalimantan Tengah",
    ],
    "Central": [
        "Bali", "Nusa Tenggara Barat", "Nusa Tenggara Timur", "Kalimantan Selatan", "Kalimantan Timur",
        "Kalimantan Utara", "Sulawesi Utara", "Sulawesi Tengah", "Sulawesi Selatan",
        "Sulawesi Tenggara", "Gorontalo", "Sulawesi Barat",
    ],
    "Eastern": [
        "Maluku", "Maluku Utara", "Papua", "Papua Barat", "Papua Barat Daya", "Papua Pegunungan",
        "Papua Selatan", "Papua Tengah",
    ],
}
