"""Registry of table models: column order, key columns and cell kinds.

The registry is data.  Five presets are here under the bare table names; a
deployment adds its own with :func:`register_model`, also to give a preset a
second name: ``register_model(get_model("morosos").renamed("my_table"))``.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

CELL_KINDS = ("decimal", "int32", "int64", "required", "optional", "date_shape")


@dataclass(frozen=True)
class TableModel:
    name: str
    columns: tuple[str, ...]
    keys: tuple[str, ...]
    numeric: tuple[str, ...] = ()
    kinds: dict[str, str] = field(default_factory=dict, hash=False)

    def __post_init__(self) -> None:
        for group in (self.keys, self.numeric, self.kinds):
            unknown = [name for name in group if name not in self.columns]
            if unknown:
                raise ValueError(f"model {self.name!r} names unknown columns {unknown}")
        wrong = {name: kind for name, kind in self.kinds.items() if kind not in CELL_KINDS}
        if wrong:
            raise ValueError(f"model {self.name!r} has unknown cell kinds {wrong}")

    @property
    def width(self) -> int:
        return len(self.columns)

    @property
    def header(self) -> str:
        return ",".join(self.columns)

    def position(self, column: str) -> int:
        return self.columns.index(column)

    def renamed(self, name: str) -> TableModel:
        return replace(self, name=name)


# --- fixed values: the preset tables, columns in file order ---
MOROSOS = TableModel(
    name="morosos",
    columns=(
        "Cuil", "IdTransmit", "NroDoc", "ApellidoNombre", "IdCliente", "IdRegion", "RazonSocial",
        "Telefono", "NombreRegion", "NombreCategoria", "Periodo", "IdEntidad", "CreateDate", "CreateUser",
    ),
    keys=("Cuil", "IdTransmit"),
    numeric=("Cuil", "IdTransmit", "NroDoc", "IdCliente", "IdRegion", "Periodo", "IdEntidad"),
    kinds={
        "Cuil": "decimal", "IdTransmit": "int32", "NroDoc": "required", "ApellidoNombre": "required",
        "IdCliente": "int32", "IdRegion": "int32", "RazonSocial": "required", "Telefono": "optional",
        "NombreRegion": "required", "NombreCategoria": "required", "Periodo": "required",
        "IdEntidad": "int32", "CreateDate": "required", "CreateUser": "required",
    },
)
PERSONAS_TELEFONOS = TableModel(
    name="personas_telefonos",
    columns=(
        "IdCliente", "IdTransmit", "NroDoc", "NroTelefono", "ApellidoNombre", "RazonSocial", "NombreRegion",
        "Direccion", "DireccionAfip", "Mail", "IdEntidad", "CreateDate", "CreateUser",
    ),
    keys=("IdCliente", "IdTransmit"),
    numeric=("IdCliente", "IdTransmit", "NroDoc", "NroTelefono", "IdEntidad"),
)
PERSONAS_TELEFONOS_CUIL = TableModel(
    name="personas_telefonos_cuil",
    columns=("Cuil", "IdTelefono", "Telefono", "Prefijo", "CreateUser", "CreateDate"),
    keys=("Cuil", "IdTelefono"),
)
EMPLEADORES = TableModel(
    name="empleadores",
    columns=("Cuit", "RazonSocial", "Domicilio", "CodPostal", "Localidad", "NombreProvincia", "Telefono"),
    keys=("Cuit",),
    numeric=("Cuit",),
    kinds={
        "Cuit": "decimal", "RazonSocial": "required", "Domicilio": "required", "CodPostal": "required",
        "Localidad": "required", "NombreProvincia": "required", "Telefono": "optional",
    },
)
EMPLEADORES_RELACIONES = TableModel(
    name="empleadores_relaciones",
    columns=("Cuil", "Cuit", "FechaIngreso", "FechaBaja"),
    keys=("Cuil", "Cuit"),
    numeric=("Cuil", "Cuit"),
    kinds={"Cuil": "int64", "Cuit": "int64", "FechaIngreso": "date_shape", "FechaBaja": "date_shape"},
)

_MODELS: dict[str, TableModel] = {}


def register_model(model: TableModel) -> TableModel:
    _MODELS[model.name.lower()] = model
    return model


for _preset in (MOROSOS, PERSONAS_TELEFONOS, PERSONAS_TELEFONOS_CUIL, EMPLEADORES, EMPLEADORES_RELACIONES):
    register_model(_preset)


def get_model(model: str | TableModel) -> TableModel:
    """Look a model up by name, whatever its case."""
    if isinstance(model, TableModel):
        return model
    try:
        return _MODELS[model.lower()]
    except KeyError:
        raise ValueError(f"unknown table model {model!r}; registered: {sorted(_MODELS)}") from None
