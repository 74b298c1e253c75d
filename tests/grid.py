"""A small hand-written grid: two stations, two lines, one transformer, one switch, one load, one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

CIM = "http://iec.ch/TC57/2013/CIM-schema-cim16#"

EQ = """
gr1 a GeographicalRegion; IdentifiedObject.name "NO"
gr2 a GeographicalRegion; IdentifiedObject.name "SE"
sg1 a SubGeographicalRegion; IdentifiedObject.mRID "sg1"; IdentifiedObject.name "NO1"; SubGeographicalRegion.Region gr1
sg2 a SubGeographicalRegion; IdentifiedObject.mRID "sg2"; IdentifiedObject.name "SE1"; SubGeographicalRegion.Region gr2
ss1 a Substation; IdentifiedObject.mRID "ss1"; IdentifiedObject.name "North"; Substation.Region sg1
ss2 a Substation; IdentifiedObject.mRID "ss2"; IdentifiedObject.name "East"; Substation.Region sg2
bv1 a BaseVoltage; IdentifiedObject.mRID "bv1"; BaseVoltage.nominalVoltage "420"
bv2 a BaseVoltage; IdentifiedObject.mRID "bv2"; BaseVoltage.nominalVoltage "132"
vl1 a VoltageLevel; IdentifiedObject.mRID "vl1"; VoltageLevel.BaseVoltage bv1; VoltageLevel.Substation ss1
vl2 a VoltageLevel; IdentifiedObject.mRID "vl2"; VoltageLevel.BaseVoltage bv1; VoltageLevel.Substation ss2
vl3 a VoltageLevel; IdentifiedObject.mRID "vl3"; VoltageLevel.BaseVoltage bv2; VoltageLevel.Substation ss1
cn1 a ConnectivityNode; IdentifiedObject.mRID "cn1"; ConnectivityNode.ConnectivityNodeContainer vl1
cn2 a ConnectivityNode; IdentifiedObject.mRID "cn2"; ConnectivityNode.ConnectivityNodeContainer vl2
cn3 a ConnectivityNode; IdentifiedObject.mRID "cn3"; ConnectivityNode.ConnectivityNodeContainer vl3
l1 a ACLineSegment; IdentifiedObject.mRID "l1"; IdentifiedObject.name "L1"; ACLineSegment.r "1.5"; ACLineSegment.x "2"; ACLineSegment.bch "3"; Conductor.length "10"; ConductingEquipment.BaseVoltage bv1; Equipment.networkAnalysisEnable "true"
l2 a ACLineSegment; IdentifiedObject.mRID "l2"; IdentifiedObject.name "HVDC L2"; ACLineSegment.r "1"; ACLineSegment.x "2"; ACLineSegment.bch "3"; ACLineSegment.gch "4"; Conductor.length "10"; ConductingEquipment.BaseVoltage bv1
l3 a ACLineSegment; IdentifiedObject.mRID "l3"; IdentifiedObject.name "off"; ACLineSegment.r "1"; ACLineSegment.x "2"; ACLineSegment.bch "3"; Conductor.length "10"; ConductingEquipment.BaseVoltage bv1; Equipment.networkAnalysisEnable "false"
t11 a Terminal; IdentifiedObject.mRID "t11"; IdentifiedObject.name "T11"; Terminal.ConductingEquipment l1; Terminal.ConnectivityNode cn1; ACDCTerminal.sequenceNumber "1"
t12 a Terminal; IdentifiedObject.mRID "t12"; IdentifiedObject.name "T12"; Terminal.ConductingEquipment l1; Terminal.ConnectivityNode cn2; ACDCTerminal.sequenceNumber "2"
t21 a Terminal; IdentifiedObject.mRID "t21"; IdentifiedObject.name "T21"; Terminal.ConductingEquipment l2; Terminal.ConnectivityNode cn1; ACDCTerminal.sequenceNumber "1"
t22 a Terminal; IdentifiedObject.mRID "t22"; IdentifiedObject.name "T22"; Terminal.ConductingEquipment l2; Terminal.ConnectivityNode cn2; ACDCTerminal.sequenceNumber "2"
t31 a Terminal; IdentifiedObject.mRID "t31"; Terminal.ConductingEquipment l3; Terminal.ConnectivityNode cn1; ACDCTerminal.sequenceNumber "1"
t32 a Terminal; IdentifiedObject.mRID "t32"; Terminal.ConductingEquipment l3; Terminal.ConnectivityNode cn2; ACDCTerminal.sequenceNumber "2"
ls1 a OperationalLimitSet; OperationalLimitSet.Equipment l1
ol1 a ActivePowerLimit; IdentifiedObject.name "Normal@20"; OperationalLimit.OperationalLimitSet ls1; ActivePowerLimit.value "900"
ol2 a ActivePowerLimit; IdentifiedObject.name "Other@20"; OperationalLimit.OperationalLimitSet ls1; ActivePowerLimit.value "9000"
sw1 a Breaker; IdentifiedObject.mRID "sw1"; IdentifiedObject.name "S1"; Switch.normalOpen "false"; Equipment.networkAnalysisEnable "true"
s11 a Terminal; IdentifiedObject.mRID "s11"; Terminal.ConductingEquipment sw1; Terminal.ConnectivityNode cn1; ACDCTerminal.sequenceNumber "1"
s12 a Terminal; IdentifiedObject.mRID "s12"; Terminal.ConductingEquipment sw1; Terminal.ConnectivityNode cn3; ACDCTerminal.sequenceNumber "2"
sw2 a Disconnector; IdentifiedObject.mRID "sw2"; IdentifiedObject.name "S2"; Switch.normalOpen "true"; Equipment.networkAnalysisEnable "false"
s21 a Terminal; IdentifiedObject.mRID "s21"; Terminal.ConductingEquipment sw2; Terminal.ConnectivityNode cn1; ACDCTerminal.sequenceNumber "1"
ld1 a NonConformLoad; IdentifiedObject.mRID "ld1"; IdentifiedObject.name "Load"; Equipment.EquipmentContainer vl1
d1 a Terminal; IdentifiedObject.mRID "d1"; Terminal.ConductingEquipment ld1; Terminal.ConnectivityNode cn1; ACDCTerminal.sequenceNumber "1"
gm1 a SynchronousMachine; IdentifiedObject.mRID "gm1"; IdentifiedObject.name "Machine"; RotatingMachine.ratedS "100"; Equipment.EquipmentContainer vl1; RotatingMachine.GeneratingUnit gu1
gu1 a GeneratingUnit; IdentifiedObject.mRID "gu1"; GeneratingUnit.minOperatingP "-5"; GeneratingUnit.maxOperatingP "50"
g1 a Terminal; IdentifiedObject.mRID "g1"; Terminal.ConductingEquipment gm1; Terminal.ConnectivityNode cn1; ACDCTerminal.sequenceNumber "1"
pt1 a PowerTransformer; IdentifiedObject.mRID "pt1"; IdentifiedObject.name "Trafo"; Equipment.EquipmentContainer ss1
te1 a PowerTransformerEnd; IdentifiedObject.mRID "te1"; IdentifiedObject.name "W1"; PowerTransformerEnd.PowerTransformer pt1; TransformerEnd.Terminal p1; TransformerEnd.endNumber "1"; PowerTransformerEnd.ratedU "420"; PowerTransformerEnd.r "1"; PowerTransformerEnd.x "2"; PowerTransformerEnd.b "0"; PowerTransformerEnd.g "0"
te2 a PowerTransformerEnd; IdentifiedObject.mRID "te2"; IdentifiedObject.name "W2"; PowerTransformerEnd.PowerTransformer pt1; TransformerEnd.Terminal p2; TransformerEnd.endNumber "2"; PowerTransformerEnd.ratedU "120"; PowerTransformerEnd.r "1"; PowerTransformerEnd.x "2"; PowerTransformerEnd.b "0"; PowerTransformerEnd.g "0"; PowerTransformerEnd.phaseAngleClock "5"
rt2 a RatioTapChanger; RatioTapChanger.TransformerEnd te2; RatioTapChanger.stepVoltageIncrement "2.5"; TapChanger.neutralStep "4"; TapChanger.normalStep "5"
p1 a Terminal; IdentifiedObject.mRID "p1"; Terminal.ConductingEquipment pt1; Terminal.ConnectivityNode cn1; ACDCTerminal.sequenceNumber "1"
p2 a Terminal; IdentifiedObject.mRID "p2"; Terminal.ConductingEquipment pt1; Terminal.ConnectivityNode cn3; ACDCTerminal.sequenceNumber "2"
"""

STATE = """
tn1 a TopologicalNode; IdentifiedObject.mRID "tn1"; IdentifiedObject.name "TN1"; TopologicalNode.BaseVoltage bv1; TopologicalNode.ConnectivityNodeContainer vl1
tn2 a TopologicalNode; IdentifiedObject.mRID "tn2"; IdentifiedObject.name "TN2"; TopologicalNode.BaseVoltage bv1; TopologicalNode.ConnectivityNodeContainer vl2
ti1 a TopologicalIsland; IdentifiedObject.name "Main"; TopologicalIsland.AngleRefTopologicalNode tn2; TopologicalIsland.TopologicalNodes tn1; TopologicalIsland.TopologicalNodes tn2
cn1 a ConnectivityNode; ConnectivityNode.TopologicalNode tn1
t12 a Terminal; Terminal.TopologicalNode tn2; ACDCTerminal.connected "true"
t11 a Terminal; ACDCTerminal.connected "true"
t21 a Terminal; ACDCTerminal.connected "true"
t22 a Terminal; ACDCTerminal.connected "false"
t31 a Terminal; ACDCTerminal.connected "true"
t32 a Terminal; ACDCTerminal.connected "true"
d1 a Terminal; ACDCTerminal.connected "true"
g1 a Terminal; ACDCTerminal.connected "true"
p1 a Terminal; ACDCTerminal.connected "true"
p2 a Terminal; ACDCTerminal.connected "true"
v1 a SvVoltage; SvVoltage.TopologicalNode tn1; SvVoltage.v "410"; SvVoltage.angle "1"
v2 a SvVoltage; SvVoltage.TopologicalNode tn2; SvVoltage.v "0"; SvVoltage.angle "2"
f11 a SvPowerFlow; SvPowerFlow.Terminal t11; SvPowerFlow.p "-9.5"; SvPowerFlow.q "1"
f12 a SvPowerFlow; SvPowerFlow.Terminal t12; SvPowerFlow.p "10"; SvPowerFlow.q "2"
f21 a SvPowerFlow; SvPowerFlow.Terminal t21; SvPowerFlow.p "3"; SvPowerFlow.q "2"
fd1 a SvPowerFlow; SvPowerFlow.Terminal d1; SvPowerFlow.p "7"; SvPowerFlow.q "1"
fg1 a SvPowerFlow; SvPowerFlow.Terminal g1; SvPowerFlow.p "-20"; SvPowerFlow.q "1"
fp1 a SvPowerFlow; SvPowerFlow.Terminal p1; SvPowerFlow.p "6"; SvPowerFlow.q "1"
st1 a SvStatus; SvStatus.ConductingEquipment l1; SvStatus.inService "false"
i1 a SvInjection; SvInjection.TopologicalNode tn1; SvInjection.pInjection "4"
sw1 a Breaker; Switch.open "true"
"""


def quads(spark: SparkSession, text: str, graph: str) -> DataFrame:
    """Quads of lines `subject a Class; Property value; ...`; quoted values are literals."""
    rows = []
    for line in filter(None, text.strip().splitlines()):
        subject, _, rest = line.partition(" ")
        for fact in rest.split("; "):
            prop, _, value = fact.partition(" ")
            if prop == "a":
                rows.append((graph, subject, "rdf:type", CIM + value, "iri", None, None))
            elif value.startswith('"'):
                rows.append((graph, subject, f"cim:{prop}", value.strip('"'), "literal", None, None))
            else:
                rows.append((graph, subject, f"cim:{prop}", value, "iri", None, None))
    return spark.createDataFrame(
        rows, "graph string, subject string, predicate string, object string, object_kind string, datatype string, lang string"
    )
