"""The paged listing of a collection as a Spark data source: one partition for each page."""

from __future__ import annotations

import json
import math
import re
import time
import unicodedata
import urllib.request
from collections.abc import Callable, Iterator
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, InputPartition

from ..operators.collection import TYPE_ALIASES, TYPE_NAMES, type_predicates

SCHEMA = "item_id string, title string, doc_number string, doc_type string, issue_date string, effective_date string, issuer string, status string, summary string, list_page int, type_id string, keyword string, error string"

# The service's ids of document types, and what it is asked besides.
SERVICE_TYPES = {
    "hien_phap": "58bf04c0-a197-4d6e-96e9-2e51066209b5", "bo_luat": "404b68a7-8e71-4ee5-a6c0-07e59f35f824",
    "luat": "11025e19-2dd6-4165-85ad-ab6241186a1a", "phap_lenh": "1cd0d144-ccb5-4196-8b56-9a3f599c9341",
    "nghi_dinh": "0d08b84c-7de7-4800-8760-2a68265e7890", "thong_tu": "178c63a9-73ff-4fd4-9d91-18d690520090",
    "quyet_dinh": "0a5362e8-cdca-436e-96cd-979598df3b16", "lenh": "43323400-7d47-418e-80ef-a912a349d4e3",
    "nghi_quyet": "044d941c-40de-45b9-ae84-51f5a730bfe0", "nghi_quyet_lien_tich": "048dd409-3441-4c13-a5ae-80236ad3ce68",
    "van_ban_hop_nhat": "26b8a9ff-1b59-4c57-9605-f2ad4ed7c324", "van_ban_hanh_chinh_lien_quan": "25fad6ae-78f6-4acd-a70e-da19032729af",
    "ban_dich_van_ban": "9979b9a4-9e4c-4a14-a990-6d86e11b75c5", "chi_thi": "0045710b-eb54-4ce5-b511-76aa23f3021b",
    "van_ban_he_thong_hoa": "c1e77420-856e-4741-973b-82e41c3783e5", "chua_xac_dinh": "9f3a2c7e-4b6d-4f1a-a9d8-2c8e5b7a41f3",
    "thong_tu_lien_tich": "0e4f2bde-5ccb-4001-9e0a-b43f51cca5e8", "thong_tu_lien_bo": "88516734-9f43-4d32-8f54-256109edfbd4",
    "cong_uoc": "956a1482-c8b2-4b1b-8b50-31df8582ae6e", "thong_bao": "ed938c9b-e50d-42f8-80b9-e945f207bd04",
    "van_ban_khac": "39a344bd-d086-4fd9-880c-9ecefdb19a40", "sac_luat": "276cbd73-5b42-4b90-a6a7-ee1bca492b7d",
    "quy_dinh": "608e6760-929a-44b0-9a67-ea41c903e6b9", "sac_lenh": "1e0386d2-9395-4a0f-9d04-18a9e01f0ca7",
    "cong_van": "ecc6bbe0-5d0c-4916-836b-bb2f8146249c", "van_ban_lien_quan": "e154c97d-d4d8-4968-9b72-feffa38924d5",
}
ASKED = {"sortBy": "issueDate", "sortDirection": "desc", "score": False, "agencyLevel": "TRUNG_UONG", "searchIn": "title", "matchMode": "all_words"}
# End of the fixed values.


class Unread(Exception):
    """A page that could not be read, after all attempts."""


def with_retries(call: Callable[[], dict | None], attempts: int = 3, delay: float = 0.0, errors: list[Exception] | None = None) -> dict | None:
    """The result of a call, tried again after errors with growing pauses; null when all fail. `errors` takes what went wrong."""
    for i in range(1, attempts + 1):
        try:
            return call()
        except (OSError, ValueError) as e:
            if errors is not None:
                errors.append(e)
            time.sleep(delay * i)
    return None


def listing_payload(page: int, page_size: int, type_id: str, keyword: str) -> dict:
    """What is asked of the server: newest first, the types by their ids, all words of the keyword in the title.

    Without a type all are asked for; a type without an id sets no filter, and the answer is filtered by name.
    """
    wanted = TYPE_ALIASES.get(type_id, type_id)
    kinds = [SERVICE_TYPES[wanted]] if wanted in SERVICE_TYPES else [] if wanted else [SERVICE_TYPES[t] for t in TYPE_NAMES]
    return {"pageNumber": page, "pageSize": page_size, "keyword": keyword or "", **ASKED} | ({"docType": kinds} if kinds else {})


def _plain(text: object) -> str:
    """Text without accents and case, white space as one blank."""
    plain = "".join(c for c in unicodedata.normalize("NFD", str(text or "")) if unicodedata.category(c) != "Mn").replace("đ", "d").replace("Đ", "D")
    return re.sub(r"\s+", " ", plain).strip().lower()


def is_of_type(item: dict, type_id: str) -> bool:
    """Whether an item is of a type, by its type's name or the start of its title; see `collection.matches_type`."""
    wanted = TYPE_ALIASES.get(type_id, type_id)
    if wanted not in TYPE_NAMES:
        return True
    forms = [_plain(_name(item.get("docType"))), _plain(item.get("title"))]
    names, longer = type_predicates()[wanted]
    begins = lambda several: any(f == n or f.startswith((n + " ", n + "-")) for f in forms for n in several)
    return not begins(longer) and begins(names)


def _name(value: object) -> str:
    if isinstance(value, dict):
        return next((str(value[k]) for k in ("name", "title", "code") if value.get(k)), "")
    return str(value or "")


def item_row(item: dict, page: int, type_id: str, keyword: str) -> tuple:
    """One list item as a row of `SCHEMA`; fields that can be objects are read by name."""
    first = lambda *names: next((_name(item[n]) for n in names if item.get(n)), "")
    return (first("id"), first("title"), first("docNum"), first("docType"), first("issueDate"), first("effFrom"), first("agencyName", "organization"), first("effStatus", "status"), first("docAbs"), page, type_id, keyword, None)


def folder_transport(folder: str) -> Callable[[dict], dict | None]:
    """Pages that lie as page_<n>.json in a folder, with the items that have all words of the keyword in the title; null for a page that isn't there."""

    def get(payload: dict) -> dict | None:
        path = Path(folder, f"page_{payload['pageNumber']}.json")
        if not path.exists():
            return None
        reply = json.loads(path.read_text(encoding="utf-8"))
        words = set(_plain(payload["keyword"]).split())
        if words:
            data = reply["data"] if isinstance(reply.get("data"), dict) else reply
            data["items"] = [x for x in data.get("items") or [] if words <= set(_plain(x.get("title")).split())]
        return reply

    return get


def http_transport(url: str, timeout: float = 30.0) -> Callable[[dict], dict | None]:
    """Pages by POST; certificates are verified."""

    def get(payload: dict) -> dict | None:
        request = urllib.request.Request(url, json.dumps(payload).encode(), {"Content-Type": "application/json"})
        with urllib.request.urlopen(request, timeout=timeout) as reply:  # noqa: S310
            return json.load(reply)

    return get


def _items(reply: dict | None) -> tuple[list[dict], int]:
    data = (reply or {}).get("data")
    data = data if isinstance(data, dict) else reply or {}
    return [x for x in data.get("items") or [] if isinstance(x, dict)], int(data.get("total") or 0)


class PagePartition(InputPartition):
    def __init__(self, page: int, error: str | None = None):
        super().__init__(page)
        self.page, self.error = page, error


class ListingReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options  # a mapping that takes names in any case
        self.size = int(options.get("pageSize", 50))
        self.type_id, self.keyword = options.get("typeId", ""), options.get("keyword", "")
        self.after = int(options.get("afterPage", 0))
        self.rows_of_errors = options.get("onError", "fail") == "row"

    def _get(self, page: int) -> dict:
        transport = http_transport(self.options["url"]) if "url" in self.options else folder_transport(self.options["path"])
        payload = listing_payload(page, self.size, self.type_id, self.keyword) | json.loads(self.options.get("ask", "{}"))
        errors: list[Exception] = []
        reply = with_retries(lambda: transport(payload), int(self.options.get("attempts", 3)), float(self.options.get("delay", 0)), errors)
        if reply is None:
            raise Unread(f"page {page} of the listing could not be read: {errors[-1] if errors else 'it is not there'}")
        return reply

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Equality on the type or the keyword is asked of the server where none is set; Spark looks at all filters again."""
        for f in filters:
            if isinstance(f, EqualTo) and f.attribute == ("type_id",) and not self.type_id:
                self.type_id = f.value
            elif isinstance(f, EqualTo) and f.attribute == ("keyword",) and not self.keyword:
                self.keyword = f.value
            yield f

    def partitions(self) -> list[InputPartition]:
        """The pages after those read before, up to the last one or to `maxPages`; those of `pages` alone where these are given."""
        if given := self.options.get("pages"):
            return [PagePartition(int(p)) for p in given.split(",")]
        try:
            _, total = _items(self._get(1))
        except Unread as e:
            if not self.rows_of_errors:
                raise
            return [PagePartition(1, str(e))]
        last = math.ceil(total / self.size) or 1
        if most := int(self.options.get("maxPages", 0)):
            last = min(last, self.after + most)
        return [PagePartition(p) for p in range(self.after + 1, last + 1)] or [PagePartition(0)]

    def read(self, partition: PagePartition) -> Iterator[tuple]:
        error = partition.error
        if partition.page and not error:
            try:
                for item in _items(self._get(partition.page))[0]:
                    if is_of_type(item, self.type_id):
                        yield item_row(item, partition.page, self.type_id, self.keyword)
            except Unread as e:
                if not self.rows_of_errors:
                    raise
                error = str(e)
        if error:
            yield (*[None] * 9, partition.page, self.type_id, self.keyword, error)


class ListingSource(DataSource):
    """Options: path (folder of pages) or url, pageSize, typeId, keyword, maxPages, afterPage, pages, attempts, delay, onError, ask.

    ask: further fields of what the server is asked, as a JSON object; they win over those that are set here.
    onError: `fail` (the default) ends the job at a page that can't be read after all attempts; `row` gives a row for it that has
    nothing but the page and the error, so it can be read again by `pages`.
    """

    @classmethod
    def name(cls) -> str:
        return "document_listing"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> ListingReader:
        return ListingReader(self.options)


def read_listing(spark: SparkSession, **options: str | int) -> DataFrame:
    """The listing as a DataFrame; filters on type and keyword reach the source, items of another type than asked for are left out."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(ListingSource)
    return spark.read.format("document_listing").options(**options).load()


def total_pages(count: int | None, page_size: int) -> tuple[int, int]:
    """(items, pages) of a listing; zeros when it couldn't be counted."""
    return (0, 0) if count is None else (count, math.ceil(count / page_size) or 1)
