"""Hand-written rows following FIXTURES.md."""

import json
import os


def biz(id, categories, city="San Jose", state="CA", lat=37.3, lon=-121.9, address1="1 Main St",
        address2=None, zip_code="95112", price="$$", name=None, alias=None, review_count=10,
        with_price=True):
    rec = {
        "id": id, "alias": alias or f"{id}-alias", "name": name or f"Shop {id}",
        "image_url": f"img/{id}.jpg", "is_closed": False, "url": f"biz/{id}",
        "review_count": review_count,
        "categories": [{"alias": a, "title": a.title()} for a in categories],
        "rating": 4.5, "coordinates": {"latitude": lat, "longitude": lon},
        "transactions": ["pickup"],
        "location": {"address1": address1, "address2": address2, "city": city,
                     "state": state, "zip_code": zip_code},
        "phone": "+15550000000", "display_phone": "(555) 000-0000", "distance": 12.5,
    }
    if with_price:
        rec["price"] = price
    return rec


# city list (file order matters; one non-ASCII name).
CITY_CSV = """Name,Latitude,Longitude
San Jose,37.3382082,-121.8863286
Torrance,33.8358492,-118.3406288
La Cañada Flintridge,34.2068,-118.2001
Carmel-By-the-Sea,36.5552,-121.9233
Oakland,37.8044,-122.2712
"""

# county list (a city absent from F1, an F1 city absent here, a city twice).
COUNTY_CSV = """Entity Name,Entity ID,Entity Type,County Name,City,State,Zip,Estimated Population,Class Data,Fiscal Year End,Paper Report Due Date,Electronic Report Due Date
City of San Jose,1,City,Santa Clara,San Jose,CA,95112,1000000,Charter,630,1031,1031
City of Torrance,2,City,Los Angeles,Torrance,CA,90501,140000,Charter,630,1031,1031
City of Torrance,3,City,Los Angeles,Torrance,CA,90503,140000,Charter,630,1031,1031
City of Fresno,4,City,Fresno,Fresno,CA,93650,540000,Charter,630,1031,1031
City of La Cañada Flintridge,5,City,Los Angeles,La Cañada Flintridge,CA,91011,20000,General Law,630,1031,1031
"""


def write(path, name, text):
    p = os.path.join(path, name)
    os.makedirs(os.path.dirname(p), exist_ok=True)
    with open(p, "w", encoding="utf-8") as f:
        f.write(text)
    return p


def write_landing_file(path, term, location, index, records):
    return write(path, f"{term}-{location}-{index}.json", json.dumps(records))
