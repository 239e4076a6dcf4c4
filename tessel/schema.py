"""Record shapes and fixed vocabularies."""

from __future__ import annotations

#: Fixed values.
PROVINCES = ["Gauteng", "Western Cape", "KwaZulu-Natal", "Eastern Cape", "Free State", "Limpopo", "Mpumalanga", "North West", "Northern Cape"]
PERFORMER_ROLES = ["conductor", "soloist", "orchestra", "ensemble", "choir", "chorus_master", "director", "narrator", "accompanist", "other"]
PREMIERES = ["world", "african", "south_african", "regional"]
GENRE_TAGS = [
    "orchestral", "chamber", "choral", "opera", "solo_recital", "song_recital", "early_music", "contemporary",
    "organ", "wind_band", "sacred", "youth", "masterclass", "competition", "crossover", "film_music",
]
VENDORS = ["quicket", "webtickets", "computicket", "howler", "direct", "at_door", "other"]
STATUSES = ["scheduled", "postponed", "cancelled", "sold_out", "unconfirmed"]
STATUS_RANK = {"cancelled": 4, "postponed": 3, "sold_out": 2, "scheduled": 1, "unconfirmed": 0}
ROLE_RANK = {"presenter": 0, "venue": 1, "aggregator": 2, "vendor": 3}

#: Rules.
PUBLISH_CONFIDENCE = 0.75
DESCRIPTION_MAX = 400
SPAN_WORDS = 12
HORIZON_MONTHS = 24
TITLE_THRESHOLD = 0.6
FAILURES_BEFORE_ALERT = 3
MAX_ATTEMPTS = 3
SAME_PERFORMANCE_S = 3600

VENUE = "struct<venue_id:string,name:string,address:string,city:string,province:string,lat:double,lng:double>"
PERFORMERS = "array<struct<name:string,role:string,instrument:string,is_south_african:boolean>>"
PROGRAMME = "array<struct<composer:string,work:string,catalogue:string,movements:string,is_premiere:string,arranger:string>>"
SA_CONTENT = "struct<sa_composers:array<string>,has_sa_work:boolean,languages:array<string>>"
TICKETS = "struct<url:string,vendor:string,currency:string,price_min:double,price_max:double,is_free:boolean,concessions_note:string,booking_required:boolean>"
SOURCE = "struct<url:string,publisher:string,fetched_at:string,content_hash:string,secondary_urls:array<string>>"

#: One performance, in the order of its published keys.
EVENT = (
    f"id string, dedupe_key string, title string, subtitle string, description string, start string, end string, doors string, duration_minutes int, "
    f"venue {VENUE}, presenter string, series string, performers {PERFORMERS}, programme {PROGRAMME}, sa_content {SA_CONTENT}, genre_tags array<string>, "
    f"tickets {TICKETS}, source {SOURCE}, status string, confidence double, needs_review array<string>, extraction_notes string, first_seen string, last_updated string"
)
EVENT_COLUMNS = [c.split()[0] for c in EVENT.replace(", ", "\n").split("\n")]

#: What an extractor returns; the rest is the pipeline's.
RAW = (
    f"title string, subtitle string, description string, start string, end string, doors string, duration_minutes double, venue {VENUE}, presenter string, series string, "
    f"performers {PERFORMERS}, programme {PROGRAMME}, sa_content {SA_CONTENT}, genre_tags array<string>, tickets {TICKETS}, source struct<url:string>, status string, "
    f"confidence double, needs_review array<string>, extraction_notes string"
)
VENUES = "venue_id string, name string, aliases array<string>, address string, city string, province string, lat double, lng double"
DOCUMENT = "url string, source string, fetched_at string, content_hash string, text string, default_presenter string"
DECISIONS = "id string, decision string, decided_at string, fingerprint string, title string"
