"""Schemas of landed and parsed rows."""

#: A landed payload: what was fetched, from where, for which source.
PAYLOAD = "source string, page_url string, payload string, category_id int"
CALENDAR = "name string, url string, country string, default_category string, timezone string, source_locale string, organiser_name string"
EVENT = (
    "source_id string, source_url string, source_name string, page_url string, source_category_id int, category string, title string, subtitle string, "
    "date_range_text string, start timestamp_ntz, end timestamp_ntz, timezone string, country string, city string, venue string, icao string, organiser string, "
    "description string, event_url string, latitude double, longitude double, source_locale string"
)
LISTING = (
    "source_id string, source_url string, source_name string, posted_date string, title string, description string, year int, engine string, total_time double, "
    "engine_hours double, cycles double, mtow double, rescue_system string, annual_inspection string, dulv_ref string, price double, price_negotiable boolean, "
    "location string, city string, airfield_name string, icao string, registration string, serial_number string, airworthy boolean, avionics string, country string, "
    "empty_weight double, max_takeoff_weight double, fuel_capacity double, fuel_type string, cruise_speed double, max_speed double, max_range double, "
    "service_ceiling double, climb_rate double, fuel_consumption double, contact_name string, contact_email string, contact_phone string, image_urls array<string>"
)
PART = (
    "source_id string, source_url string, source_name string, posted_date string, title string, description string, category string, total_time double, "
    "condition string, price double, price_negotiable boolean, vat_included boolean, contact_name string, contact_email string, contact_phone string, "
    "image_urls array<string>, location string"
)
