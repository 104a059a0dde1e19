"""Names and identifiers that existing graphs, topics and tables already use.

Everything here is a fixed value: identifiers built from these strings must be
byte-for-byte those stored by earlier runs, or nothing would match on re-import.
"""

# Namespace prefixes.
PREFIXES = {
    "bigg": "http://bigg-project.eu/ontology#",
    "icaen": "https://icaen.cat#",
    "geonames": "https://www.geonames.org/ontology#",
    "geodata": "https://sws.geonames.org/",
    "xsd": "http://www.w3.org/2001/XMLSchema#",
    "rdf": "http://www.w3.org/1999/02/22-rdf-syntax-ns#",
    "unit": "http://qudt.org/vocab/unit/",
}

# Identifiers of a device, its sensors and its measurements.
PROVIDER = "DatadisSource"
DEVICE_URI = "https://icaen.cat#DEVICE-DatadisSource-%s"
SENSOR_URI = "https://icaen.cat#SENSOR-datadis-%s-%s-RAW-%s"
MEASUREMENT_URI = "https://icaen.cat#%s"

# Markers.
ACTIVE = "Alta"
CANCELLED = "Accepted"
FINAL_MESSAGE = "FINAL_MESSAGE"
LOCATION_SOURCE = "DATADIS"

# Properties of a device that hold one owner each.
NIF_KEY_PREFIX = "bigg__nif_"
NIF_KEY_PATTERN = "bigg__nif_.*"

# Properties that hold an organization's own ids.
POINT_OF_DELIVERY_ID = "bigg__pointOfDeliveryIDFromOrganization"
BUILDING_ID = "bigg__buildingIDFromOrganization"
ORGANIZATION_ID = "bigg__organizationIDFromOrganization"

# Gazetteer levels and the vocabulary of its triples.
GAZETTEER_NAME = "https://www.geonames.org/ontology#name"
GAZETTEER_LEVEL = "https://www.geonames.org/ontology#featureCode"
MUNICIPALITY_LEVEL = "https://www.geonames.org/ontology#A.ADM3"
PROVINCE_LEVEL = "https://www.geonames.org/ontology#A.ADM2"

# Edge types of the property graph.
HAS_POINT_OF_DELIVERY = "hasUtilityPointOfDelivery"
HAS_SPACE = "hasSpace"
HAS_SUB_ORGANIZATION = "hasSubOrganization"
MANAGES_BUILDING = "managesBuilding"
HAS_DEVICE = "hasDevice"
HAS_LOCATION = "hasDeviceLocationInfo"
HAS_PROVINCE = "hasAddressProvince"
HAS_CITY = "hasAddressCity"
IMPORTED_FROM = "importedFromSource"

# Time-series storage layout (seconds per bucket, number of buckets).
BUCKET_SECONDS = 10_000_000
BUCKETS = 20

# What a supply record becomes in the graph. One entry per subject:
# subject template, then (predicate, object template, datatype) rules. "$(x)" is the
# record's field x, "a" is rdf:type, a quoted object is a constant literal.
SUPPLY_RULES = (
    ("icaen:BUILDINGSPACE-$(ens)", (
        ("bigg:isObservedByDevice", "icaen:DEVICE-DatadisSource-$(cups)", None),
        ("bigg:hasUtilityPointOfDelivery", "icaen:SUPPLY-$(supply_name)", None),
    )),
    ("icaen:DEVICE-DatadisSource-$(cups)", (
        ("a", "bigg:Device", None),
        ("a", "bigg:DataProvider", None),
        ("a", "bigg:Element", None),
        ("a", "bigg:Thing", None),
        ("bigg:deviceName", "$(cups)", None),
        ("bigg:distributor", "$(distributor)", None),
        ("bigg:marketer", "$(marketer)", None),
        ("bigg:tension", "$(tension)", None),
        ("bigg:accessFare", "$(accessFare)", None),
        ("bigg:contractedPower", "$(contractedPowerkW)", None),
        ("bigg:timeDiscrimination", "$(timeDiscrimination)", None),
        ("bigg:modePowerControl", "$(modePowerControl)", None),
        ("bigg:startDate", "$(startDate)", "xsd:dateTime"),
        ("bigg:endDate", "$(endDate)", "xsd:dateTime"),
        ("bigg:tariff", "$(codeFare)", None),
        ("bigg:selfConsumptionTypeCode", "$(selfConsumptionTypeCode)", None),
        ("bigg:selfConsumptionTypeDesc", "$(selfConsumptionTypeDesc)", None),
        ("bigg:partitionCoefficient", "$(partitionCoefficient)", None),
        ("bigg:cau", "$(cau)", None),
        ("bigg:installedCapacity", "$(installedCapacity)", None),
        ("bigg:lastMarketerDate", "$(lastMarketerDate)", None),
        ("bigg:maxPowerInstall", "$(maxPowerInstall)", None),
        ("bigg:hasDeviceType", "bigg:Meter.EnergyMeter.Electricity", None),
        ("bigg:hasDeviceLocationInfo", "icaen:LOCATION-DEVICE-DatadisSource-$(cups)", None),
        ("bigg:source", '"DatadisSource"', None),
        ("bigg:nif", "$(nif)", None),
        ("bigg:authorized_nif", "$(authorized_nif)", None),
        ("bigg:nif_$(nif)", "$(nif_ab)", None),
        ("bigg:enrolled", "$(enrolled)", "xsd:boolean"),
    )),
    ("icaen:SUPPLY-$(supply_name)", (
        ("a", "bigg:UtilityPointOfDelivery", None),
        ("a", "bigg:Thing", None),
        ("bigg:startDate", "$(startDate)", "xsd:dateTime"),
        ("bigg:endDate", "$(endDate)", "xsd:dateTime"),
        ("bigg:pointOfDeliveryIDFromOrganization", "$(supply_name)", None),
        ("bigg:stateCancelled", "$(stateCancelled)", None),
        ("bigg:hasUtilityType", "bigg:ElectricUtility", None),
        ("bigg:hasDevice", "icaen:DEVICE-DatadisSource-$(cups)", None),
        ("bigg:updateSupply", "$(update_date)", "xsd:dateTime"),
    )),
    ("icaen:LOCATION-DEVICE-DatadisSource-$(cups)", (
        ("a", "bigg:LocationInfo", None),
        ("bigg:addressPostalCode", "$(postalCode)", None),
        ("bigg:addressStreetName", "$(address)", None),
        ("bigg:hasAddressCity", "geodata:$(municipality)/", None),
        ("bigg:hasAddressProvince", "geodata:$(province)/", None),
    )),
)

# The same for the sensor and measurement of a meter's series.
SENSOR_RULES = (
    ("$(device_uri)", (
        ("bigg:hasSensor", "<$(sensor_uri)>", None),
    )),
    ("$(sensor_uri)", (
        ("a", "bigg:Sensor", None),
        ("a", "bigg:TimeSeriesList", None),
        ("bigg:timeSeriesEnd", "$(series_end)", "xsd:dateTime"),
        ("bigg:timeSeriesFrequency", "$(freq)", None),
        ("bigg:timeSeriesIsCumulative", '"false"', "xsd:boolean"),
        ("bigg:timeSeriesIsOnChange", '"false"', "xsd:boolean"),
        ("bigg:timeSeriesIsRegular", '"true"', "xsd:boolean"),
        ("bigg:timeSeriesStart", "$(series_start)", "xsd:dateTime"),
        ("bigg:timeSeriesTimeAggregationFunction", '"SUM"', None),
        ("bigg:hasMeasuredProperty", "bigg:EnergyConsumptionGridElectricity", None),
        ("bigg:hasMeasurementUnit", "unit:KiloW-HR", None),
        ("bigg:hasEstimationMethod", "bigg:Profiled", None),
        ("bigg:hasMeasurement", "<$(measurement_uri)>", None),
    )),
    ("$(measurement_uri)", (
        ("a", "bigg:Measurement", None),
        ("a", "bigg:TimeSeriesPoint", None),
        ("bigg:hash", "$(hash)", None),
    )),
)
