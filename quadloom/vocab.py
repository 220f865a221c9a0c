"""IRIs the operators test for or write, and the settings that pick them."""

from __future__ import annotations

from dataclasses import dataclass

# W3C namespaces and terms.
RDF_TYPE = "http://www.w3.org/1999/02/22-rdf-syntax-ns#type"
XSD_STRING = "http://www.w3.org/2001/XMLSchema#string"
LDP_NS = "http://www.w3.org/ns/ldp#"
LDP_RESOURCE = LDP_NS + "Resource"
LDP_RDF_SOURCE = LDP_NS + "RDFSource"
LDP_NON_RDF_SOURCE = LDP_NS + "NonRDFSource"
LDP_CONTAINER = LDP_NS + "Container"
LDP_BASIC_CONTAINER = LDP_NS + "BasicContainer"
LDP_DIRECT_CONTAINER = LDP_NS + "DirectContainer"
LDP_INDIRECT_CONTAINER = LDP_NS + "IndirectContainer"
LDP_CONTAINS = LDP_NS + "contains"
PREFER_CONTAINMENT = LDP_NS + "PreferContainment"
PREFER_MEMBERSHIP = LDP_NS + "PreferMembership"

# Models accepted for storage, and models that contain others.
STORABLE_MODELS = (
    LDP_RESOURCE,
    LDP_RDF_SOURCE,
    LDP_NON_RDF_SOURCE,
    LDP_CONTAINER,
    LDP_BASIC_CONTAINER,
)
CONTAINER_MODELS = (
    LDP_CONTAINER,
    LDP_BASIC_CONTAINER,
    LDP_DIRECT_CONTAINER,
    LDP_INDIRECT_CONTAINER,
)

# Key names of the string map kept with a version object,
# in front of which Settings.meta_prefix is put.
META_MODEL = "interactionModel"
META_MODIFIED = "modified"
META_CONTAINER = "container"
META_HAS_ACL = "hasACL"
META_MEMBERSHIP_RESOURCE = "membershipResource"
META_MEMBER_RELATION = "hasMemberRelation"
META_MEMBER_OF_RELATION = "isMemberOfRelation"
META_INSERTED_CONTENT = "insertedContentRelation"
META_BINARY_LOCATION = "binaryLocation"
META_BINARY_TYPE = "binaryMimeType"
META_GRAPHS = "metadataGraphs"

DEFAULT_CHUNK_SIZE = 1_048_576
VERSION_MARK = "?version="


@dataclass(frozen=True)
class Settings:
    """Names that differ between deployments.

    ``system_ns`` is put in front of the names of the system graphs which no
    public vocabulary defines; set it, ``data_prefix`` and ``meta_prefix`` to
    what existing data uses.
    """

    data_prefix: str = "data:/"
    binary_scheme: str = "s3://"
    binary_key_prefix: str = ""
    version_key_prefix: str = ""
    meta_prefix: str = ""
    system_ns: str = "urn:x-system:"
    add_type_quad: bool = True
    versioning: bool = True

    @property
    def user_graph(self) -> str:
        return self.system_ns + "PreferUserManaged"

    @property
    def server_graph(self) -> str:
        return self.system_ns + "PreferServerManaged"

    @property
    def acl_graph(self) -> str:
        return self.system_ns + "PreferAccessControl"

    @property
    def audit_graph(self) -> str:
        return self.system_ns + "PreferAudit"

    @property
    def table_ignored_graphs(self) -> tuple[str, ...]:
        """Graphs that are not metadata graphs when the state tables are read."""
        return (self.user_graph, self.server_graph)

    @property
    def object_ignored_graphs(self) -> tuple[str, ...]:
        """Graphs that are not metadata graphs when a version object is written."""
        return (self.user_graph, self.server_graph, PREFER_CONTAINMENT, PREFER_MEMBERSHIP)


DEFAULTS = Settings()
