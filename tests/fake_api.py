"""A paged API for the tests: pure functions of the request, importable by workers."""

TOTAL = 25


def offsets(request):
    start = request["offset"]
    return {"responses": [{"n": i} for i in range(start, min(start + 10, TOTAL))], "stats": {"total": TOTAL}}


def numbered(request):
    start = (request["page"] - 1) * 10
    return {"message": "success", "segments": [{"n": i} for i in range(start, min(start + 10, TOTAL))]}


def linked(request):
    start = int(request.get("next", 0))
    after = start + 10
    page = {"object": "list", "data": [{"n": i} for i in range(start, min(after, TOTAL))], "count": TOTAL}
    return {**page, "next_href": str(after) if after < TOTAL else None}


def cursor(request):
    """Record i is of second i; a page ends after ten seconds, the last one has no end time."""
    if request.get("latest"):
        return {"end_time": TOTAL}
    start = int(request["start_time"])
    end = start + 10
    return {"results": [{"n": i} for i in range(start, min(end, TOTAL))], "end_time": end if end < TOTAL else ""}


def by_id(request):
    return {"id": request["id"], "slots": [{"at": f"{request['resource']}-{request['id']}"}]}


# A burst, a long silence, single seconds with many records, and a long thin tail.
BURSTS = sorted([*range(0, 50, 7), *(1000 + i // 4 for i in range(240)), *[5000] * 9, *[5001] * 9, *range(90_000, 95_000, 100)])


def bursts(request):
    """Ten records from a second on; the end time is the last record's own, so that pages share what stands there."""
    found = [{"id": i, "at": t} for i, t in enumerate(BURSTS) if t >= int(request["start_time"])][:10]
    return {"results": found, "count": len(found), "end_time": found[-1]["at"] if found else None}


def stuck(request):
    return {"results": [{"id": i, "at": 5} for i in range(10)], "end_time": 5}


def without_link(request):
    return {"data": [{"n": 1}], "next": "2"}
