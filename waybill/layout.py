"""Where the data of each layer lives."""


class Layout:
    """Paths under one root.

    `replays` names further bronze folders under the same root, one per replayed feed, which
    are read next to the first.

    With `buckets`, silver shipments are a bucketed table of the catalog, named
    `shipments_table`; it outlives the session only where the catalog does.

    With `incremental`, silver tables are keyed tables that take in what is new in bronze;
    not together with `buckets`. With `follow_routes` too, they note what changes, and route
    metrics follow from the changes.
    """

    def __init__(
        self,
        root,
        buckets=None,
        shipments_table="silver_shipments",
        replays=(),
        incremental=False,
        follow_routes=False,
    ):
        if buckets and incremental:
            raise ValueError("a bucketed table is written whole: choose buckets or incremental")
        if follow_routes and not incremental:
            raise ValueError("route metrics follow incremental silver tables only")
        self.incremental = incremental
        self.follow_routes = follow_routes
        self.root = root.rstrip("/")
        self.buckets = buckets
        self.shipments_table = shipments_table
        self.topics = f"{self.root}/topics"
        self.checkpoints = f"{self.root}/checkpoints"
        self.bronze_shipments = f"{self.root}/bronze/shipment_events"
        self.bronze_tracking = f"{self.root}/bronze/tracking_events"
        self.shipment_folders = [self.bronze_shipments, *self._replayed("shipment_events", replays)]
        self.tracking_folders = [self.bronze_tracking, *self._replayed("tracking_events", replays)]
        self.silver_shipments = f"{self.root}/silver/shipment_events"
        self.silver_tracking = f"{self.root}/silver/tracking_events"
        changes = f"{self.root}/silver/changes" if follow_routes else None
        self.shipment_changes = changes and f"{changes}/shipment_events"
        self.tracking_changes = changes and f"{changes}/tracking_events"
        self.gold = f"{self.root}/gold"
        self.route_sums = f"{self.root}/route_sums"
        self.performance = f"{self.gold}/delivery_performance"
        self.routes = f"{self.gold}/route_optimization"
        self.snapshot = f"{self.gold}/shipment_snapshot"
        self.serving = f"{self.root}/serving"

    def _replayed(self, feed, replays):
        return [f"{self.root}/bronze-{name}/{feed}" for name in replays]
